"""Near copies by SimHash, compared exactly, tile by tile.

Equal fingerprints are one node. A node's cell is the bit counts of the four quarters of
its fingerprint; the quarters' counts of two nodes differ by no more, in sum, than the
nodes do in bits, so cells further apart than the radius are never compared. A cell is
cut into tiles of about ``TILE`` nodes, and a pair of tiles is one numpy task: exclusive
or, bit count. It hands on a spanning forest of its links, not each link.

A null, empty or wordless text has fingerprint zero and links like any other. Rows are
told apart by fingerprint alone, so repeated rows and ids change nothing; a null id never
names a component unless no other id is there. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sequon.llm.common import kept, small

TILE = 1024
#: What one task compares, about: pairs of tiles, and pairs of nodes in them.
TASK_PAIRS, TASK_WORK = 20_000, 1 << 32
QUARTERS, WIDTH = 4, 16
#: Words hashed at a time, so that the bits of a very long text are never whole.
_CHUNK = 1 << 16
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Nodes that may be broadcast with their class: 32 bytes each.
BROADCAST_NODES = 1_000_000


def simhash(text: str | None, size: int = 3, seed: int = 42) -> int:
    words = _WORD.findall((text or "").translate(_LOWER))
    if not words:
        return 0
    n = max(len(words) - size + 1, 1)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, _CHUNK):
        many = range(at, min(at + _CHUNK, n))
        hashes = np.fromiter(
            (xxhash.xxh64_intdigest(" ".join(words[i : i + size]), seed) for i in many),
            dtype=">u8",
            count=len(many),
        )
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


@F.arrow_udf(T.LongType())
def fingerprint(texts: pa.Array) -> pa.Array:
    """64 bits, in a signed long."""
    values = np.array([simhash(t.as_py()) for t in texts], dtype=np.uint64)
    return pa.array(values.view(np.int64))


def _cell(fp: Column) -> Column:
    """Bit counts of the quarters, in base 17."""
    counts = (
        F.bit_count(F.shiftrightunsigned(fp, WIDTH * q).bitwiseAND(F.lit(0xFFFF)))
        for q in range(QUARTERS)
    )
    out = F.lit(0)
    for count in counts:
        out = out * (WIDTH + 1) + count
    return out.cast("int")


def _steps(radius: int) -> list[tuple[int, ...]]:
    """Half of the differences between near cells: each pair of cells comes up once."""
    near = product(range(-radius, radius + 1), repeat=QUARTERS)
    return [s for s in near if sum(map(abs, s)) <= radius and s >= (0,) * QUARTERS]


def _near_cells(cell: Column, radius: int) -> Column:
    digits = [F.floor(cell / (WIDTH + 1) ** q) % (WIDTH + 1) for q in reversed(range(QUARTERS))]
    out = []
    for step in _steps(radius):
        moved = [d + s for d, s in zip(digits, step)]
        code = F.lit(0)
        inside = F.lit(True)
        for m in moved:
            code, inside = code * (WIDTH + 1) + m, inside & m.between(0, WIDTH)
        out.append(F.when(inside, code.cast("int")))
    return F.array_compact(F.array(*out))


def _forest(pairs: np.ndarray, n: int) -> list[int]:
    """Places in ``pairs`` that already join all that ``pairs`` joins."""
    up = list(range(n))

    def top(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    out = []
    for at, (a, b) in enumerate(pairs.tolist()):
        x, y = top(a), top(b)
        if x != y:
            up[x] = y
            out.append(at)
    return out


def _lists(column: pa.ListArray) -> list[np.ndarray]:
    """The lists of a column, as views of its values."""
    values, ends = column.values.to_numpy(), column.offsets.to_numpy()
    return [values[a:b] for a, b in zip(ends, ends[1:])]


def _compare(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = _lists(batch["mine"]), _lists(batch["other"]), batch["same"].to_pylist()
            for mine, other, same in zip(*columns):
                found = []
                for at in range(0, len(mine), 256):
                    # Unsigned: of a negative number numpy counts the bits of its absolute value.
                    apart = np.bitwise_count(
                        (mine[at : at + 256, None] ^ other[None, :]).view(np.uint64)
                    )
                    i, j = np.nonzero(apart <= radius)
                    found.append(np.stack([i + at, j], axis=1))
                pairs = np.concatenate(found)
                if same:
                    pairs = pairs[pairs[:, 0] < pairs[:, 1]]
                    ends = pairs
                else:
                    ends = pairs + np.array([0, len(mine)])
                pairs = pairs[_forest(ends, len(mine) + len(other))]
                if len(pairs):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(mine[pairs[:, 0]]), pa.array(other[pairs[:, 1]])], names=["a", "b"]
                    )

    return run


def links(nodes: DataFrame, radius: int) -> DataFrame:
    """Links (a, b) that join all different ``fp`` at most ``radius`` bits apart.

    Which tiles meet is listed first, by their names, tile by tile. Each pair then fetches its
    two tiles, dealt out by the second one to as many tasks as the comparisons ask for, so that
    the pairs of a dense cell go to many tasks.
    """
    celled = nodes.select("fp", _cell(F.col("fp")).alias("cell"))
    # At most 17^4 cells, however many nodes.
    sizes = kept(
        celled.groupBy("cell").agg(
            F.ceil(F.count("*") / TILE).alias("parts"), F.count("*").alias("nodes")
        )
    )
    placed = celled.join(F.broadcast(sizes.drop("nodes")), "cell").withColumn(
        "part", F.pmod(F.xxhash64("fp"), F.col("parts"))
    )
    tiles = kept(placed.groupBy("cell", "part").agg(F.collect_list("fp").alias("fps")))
    near = tiles.select(
        F.col("cell").alias("own"),
        F.col("part").alias("own_part"),
        F.size("fps").alias("own_size"),
        F.explode(_near_cells(F.col("cell"), radius)).alias("cell"),
    )
    # A part without nodes is no tile, and falls out where tiles are fetched.
    met = (
        near.join(F.broadcast(sizes), "cell")
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .where((F.col("own") != F.col("cell")) | (F.col("own_part") <= F.col("part")))
        .withColumn("work", F.col("own_size") * F.col("nodes") / F.col("parts"))
    )
    names = ["own", "own_part", "cell", "part"]
    pairs = kept(met.select(*names, "work"))
    n, work = pairs.agg(F.count("*"), F.coalesce(F.sum("work"), F.lit(0.0))).first()
    tasks = max(-(-n // TASK_PAIRS), int(work // TASK_WORK) + 1)
    mine = tiles.select(
        F.col("cell").alias("own"), F.col("part").alias("own_part"), F.col("fps").alias("mine")
    )
    same = (F.col("own") == F.col("cell")) & (F.col("own_part") == F.col("part"))
    fetched = (
        pairs.select(*names)
        .join(mine, ["own", "own_part"])
        .repartition(max(tasks, nodes.sparkSession.sparkContext.defaultParallelism), "cell", "part")
        .join(tiles, ["cell", "part"])
        .select("mine", F.col("fps").alias("other"), same.alias("same"))
    )
    return fetched.mapInArrow(_compare(radius), "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """``fp`` and ``root`` of each linked node: the least node it is joined to.

    Large star and small star in turn, each round written out, until nothing changes.
    """
    edges = kept(edges.where("a <> b").distinct())
    before = None
    while True:
        both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        down = kept(large.where("a <> b").distinct())
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        moved = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        kept_ = least.select("a", F.col("m").alias("b"))
        edges = kept(moved.union(kept_).where("a <> b").distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("fp"), F.col("b").alias("root"))
        before = now


def classes(digests: DataFrame, radius: int = 2) -> DataFrame:
    """``fp``, ``root`` and ``component_id`` of every fingerprint in ``digests`` (doc_id, fp).

    The root tells components apart; a ``component_id`` may be null or shared.
    """
    nodes = kept(digests.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(links(nodes, radius))
    rooted = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(ids, "root").select("fp", "root", "component_id")


def near_copies(docs: DataFrame, radius: int = 2) -> DataFrame:
    """``doc_id``, ``fingerprint`` and ``component_id`` of every row; other columns are left out."""
    digests = kept(docs.select("doc_id", fingerprint("text").alias("fp")))
    of_fp = kept(classes(digests, radius))
    joined = digests.join(small(of_fp, BROADCAST_NODES), "fp")
    return joined.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, radius: int = 2) -> DataFrame:
    """One row of each component, the one with the least id, with all its columns.

    Of several rows with that id, or where all ids are null, the first by place in the table
    stays. Null and repeated ids join nothing: components are told apart by their texts.
    """
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    placed = kept(
        docs.select(
            row.alias("row"),
            F.monotonically_increasing_id().alias("at"),
            fingerprint("text").alias("fp"),
        )
    )
    digests = placed.select(F.col("row.doc_id").alias("doc_id"), "fp", "at")
    of_fp = kept(classes(digests.select("doc_id", "fp"), radius))
    known = digests.join(small(of_fp, BROADCAST_NODES), "fp")
    first = known.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "at")).alias("f")
    )
    return placed.join(first.select(F.col("f.at").alias("at")), "at", "left_semi").select("row.*")
