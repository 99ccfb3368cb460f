"""Byte-level BPE in two tiers, and back.

A pre-token that is in the vocabulary as a whole is found by a minimal perfect hash. Any
other is merged: its bytes are nodes of a linked list, and a heap holds the pairs that
the vocabulary can merge, lowest rank first. Both tiers give what the rank file defines;
the second runs once per distinct pre-token while a worker process remembers it.

Null and empty texts have no ids; repeated rows are encoded alike; an empty table stays empty.

Ids travel packed, as little-endian unsigned 32-bit integers in one binary value.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cached_property
from heapq import heapify, heappop, heappush
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: Distinct pre-tokens in a generation that a worker process remembers, some 200 bytes each;
#: it has two.
REMEMBERED = 160_000
#: Bytes of a pre-token whose place and rank fit one small integer.
_SHORT = 127
#: Slots hold keys per bucket; the first hash chooses the bucket.
PER_BUCKET = 2
#: Longer texts are split into pre-tokens piece by piece.
_CHUNK = 1 << 20
_OWN = {"_sent", "encoder", "pairs", "tokens"}


class PerfectHash:
    """Minimal and perfect: the n keys take the slots 0 to n - 1, one each.

    Each bucket has a displacement, found largest bucket first, that sends its keys to
    free slots; the bucket of a single key names its slot, as ``-1 - slot``. A key outside the set also gets a slot; compare before use.
    """

    def __init__(self, keys: list[bytes]):
        self.n = len(keys)
        self.buckets = max(1, self.n // PER_BUCKET)
        self.shift = [0] * self.buckets
        hashes = [xxhash.xxh3_128_intdigest(k) for k in keys]
        members: dict[int, list[int]] = {}
        for h in hashes:
            members.setdefault((h >> 96) % self.buckets, []).append(h)
        taken = bytearray(self.n)
        free = 0
        for bucket, own in sorted(members.items(), key=lambda item: -len(item[1])):
            if len(own) == 1:
                free = taken.index(0, free)
                taken[free] = 1
                self.shift[bucket] = -1 - free
                continue
            shift = 0
            while True:
                slots = {self._slot(h, shift) for h in own}
                if len(slots) == len(own) and not any(taken[s] for s in slots):
                    break
                shift += 1
            for s in slots:
                taken[s] = 1
            self.shift[bucket] = shift

    def _slot(self, h: int, shift: int) -> int:
        if shift < 0:
            return -1 - shift
        # A shift changes all bits of the product, so that each is a new draw.
        mixed = ((h ^ shift * 0x9E3779B97F4A7C15) * (h >> 32 | 1)) & 0xFFFFFFFFFFFFFFFF
        return (mixed >> 32) % self.n

    def slot(self, key: bytes) -> int:
        h = xxhash.xxh3_128_intdigest(key)
        return self._slot(h, self.shift[(h >> 96) % self.buckets])


class Vocabulary:
    """Tokens by rank. ``ranks`` must hold every single byte."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("a byte-level vocabulary needs all 256 bytes")
        self.ranks, self.pattern = ranks, pattern
        self.hash = PerfectHash(list(ranks))
        self.key_at: list[bytes] = [b""] * len(ranks)
        self.id_at = [0] * len(ranks)
        for token, rank in ranks.items():
            slot = self.hash.slot(token)
            self.key_at[slot], self.id_at[slot] = token, rank

    @classmethod
    def read(cls, path: str, pattern: str) -> Vocabulary:
        """From a file of lines ``base64 rank``; read on the driver."""
        lines = Path(path).read_bytes().splitlines()
        pairs = (line.split() for line in lines if line.strip())
        return cls({base64.b64decode(a): int(b) for a, b in pairs}, pattern)

    def __getstate__(self) -> dict:
        # What is worked out on first use stays in its process.
        return {k: v for k, v in self.__dict__.items() if k not in _OWN}

    def sent(self, spark: SparkSession) -> Broadcast:
        """One broadcast per application, shared by encoding and decoding."""
        app = spark.sparkContext.applicationId
        if self.__dict__.get("_sent", (None,))[0] != app:
            self._sent = app, spark.sparkContext.broadcast(self)
        return self._sent[1]

    @cached_property
    def encoder(self) -> Encoder:
        return Encoder(self)

    @cached_property
    def pairs(self) -> list[int]:
        """Rank of every two bytes, -1 where they do not merge."""
        out = [-1] * 65_536
        for token, rank in self.ranks.items():
            if len(token) == 2:
                out[token[0] << 8 | token[1]] = rank
        return out

    @cached_property
    def tokens(self) -> dict[int, bytes]:
        return {rank: token for token, rank in self.ranks.items()}

    def whole(self, piece: bytes) -> int | None:
        """First tier: the id of a pre-token that is a token."""
        slot = self.hash.slot(piece)
        return self.id_at[slot] if self.key_at[slot] == piece else None

    def merged(self, piece: bytes) -> list[int]:
        """Second tier: merge the lowest rank first, from the left among equals."""
        ranks, pairs, n = self.ranks, self.pairs, len(piece)
        # An entry is rank, first byte and end in one integer, which orders as they do.
        bits = 7 if n <= _SHORT else n.bit_length()
        low, two = (1 << bits) - 1, 2 * bits
        # A node is named by its first byte. ends: one past its last byte; 0: merged away.
        ends = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        heap, last = [], piece[0]
        for i in range(1, n):
            byte = piece[i]
            rank = pairs[last << 8 | byte]
            if rank >= 0:
                heap.append(rank << two | i - 1 << bits | i + 1)
            last = byte
        heapify(heap)
        get = ranks.get
        while heap:
            entry = heappop(heap)
            end, left = entry & low, entry >> bits & low
            middle = ends[left]
            # Stale: one of the two nodes has changed since.
            if not middle or middle >= end or ends[middle] != end:
                continue
            ends[left], ends[middle] = end, 0
            if end < n:
                before[end] = left
                reach = ends[end]
                rank = get(piece[left:reach])
                if rank is not None:
                    heappush(heap, rank << two | left << bits | reach)
            first = before[left]
            if first >= 0:
                rank = get(piece[first:end])
                if rank is not None:
                    heappush(heap, rank << two | first << bits | end)
        out, at = [], 0
        while at < n:
            end = ends[at]
            out.append(ranks[piece[at:end]])
            at = end
        return out


class _Remembered(dict):
    """Packed ids of pre-tokens, worked out when first asked for.

    Those of the last generation stay until the next is full; what is asked for again moves
    on with it, so the common ones are never lost.
    """

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary
        self.last: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        packed = self.last.pop(piece, None)
        if packed is None:
            data = piece.encode()
            whole = self.vocabulary.whole(data)
            ids = (whole,) if whole is not None else self.vocabulary.merged(data)
            packed = b"".join([i.to_bytes(4, "little") for i in ids])
            if len(data) > 64:
                return packed
        if len(self) >= REMEMBERED:
            self.last = dict(self)
            self.clear()
        self[piece] = packed
        return packed


class Encoder:
    def __init__(self, vocabulary: Vocabulary):
        self.pieces = regex.compile(vocabulary.pattern)
        self.ids = _Remembered(vocabulary)

    def __call__(self, text: str | None) -> bytes:
        if not text:
            return b""
        if len(text) <= _CHUNK:
            return b"".join(map(self.ids.__getitem__, self.pieces.findall(text)))
        # One match at a time, so that the list of a very long text is never whole.
        out = bytearray()
        for match in self.pieces.finditer(text):
            out += self.ids[match.group()]
        return bytes(out)


def encode(spark: SparkSession, text: str | Column, vocabulary: Vocabulary) -> Column:
    """Ids of a text, packed; no special tokens. A null or empty text has none."""
    sent = vocabulary.sent(spark)

    @F.arrow_udf("binary")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = sent.value.encoder
        for batch in batches:
            yield pa.array((encoder(x.as_py()) for x in batch), pa.binary())

    return run(text)


def decode(spark: SparkSession, ids: str | Column, vocabulary: Vocabulary) -> Column:
    """Bytes of packed ids; null stays null, an id outside the vocabulary is an error."""
    sent = vocabulary.sent(spark)

    @F.arrow_udf("binary")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens = sent.value.tokens
        for batch in batches:
            yield pa.array(
                (
                    None
                    if (packed := x.as_py()) is None
                    else b"".join(map(tokens.__getitem__, np.frombuffer(packed, "<u4").tolist()))
                    for x in batch
                ),
                pa.binary(),
            )

    return run(ids)
