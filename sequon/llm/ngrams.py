"""Character n-grams as hash buckets, and their counts over whole tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_CHUNK = 1 << 20
_LETTER = regex.compile(r"\p{L}")
_OTHER = regex.compile(r"[^\p{L}\p{M}]+")


def letters(text: str | None) -> str:
    """Lower-case letters and marks, anything else between them as one blank; '' without letters."""
    if not _LETTER.search(text or ""):
        return ""
    out = _OTHER.sub(" ", (text or "").lower()).strip()
    return f" {out} "


def buckets(text: str, order: int, bits: int) -> Iterator[np.ndarray]:
    """Buckets of all n-grams, in order, a piece of the text at a time."""
    for at in range(0, max(len(text) - order + 1, 0), _CHUNK):
        piece = text[at : at + _CHUNK + order - 1]
        codes = np.frombuffer(piece.encode("utf-32-le"), "<u4").astype(np.uint64)
        n = len(codes) - order + 1
        mixed = np.zeros(n, np.uint64)
        for i in range(order):
            mixed = (mixed ^ codes[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
        yield (mixed >> np.uint64(64 - bits)).astype(np.int64)


def counts(
    texts: DataFrame, of: Callable[[str | None], Iterator[np.ndarray]], size: int
) -> dict[object, np.ndarray]:
    """``of(text)`` counted per ``group`` over all rows of ``texts`` (group, text).

    Each task adds up in arrays of ``size``, so what is shuffled follows the number of
    tasks, and what the driver gets is at most groups times ``size`` numbers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[str, np.ndarray] = {}
        for batch in batches:
            for group, text in zip(batch["group"], batch["text"]):
                total = own.setdefault(group.as_py(), np.zeros(size, np.int64))
                for found in of(text.as_py()):
                    total += np.bincount(found, minlength=size)
        for group, total in own.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([group] * len(at), pa.string()), pa.array(at), pa.array(total[at])],
                names=["group", "bucket", "n"],
            )

    parts = texts.select(F.col("group").cast("string"), "text").mapInArrow(
        run, "`group` string, bucket long, n long"
    )
    summed = parts.groupBy("group", "bucket").agg(F.sum("n").alias("n")).toPandas()
    out = {}
    for group, rows in summed.groupby("group"):
        out[group] = np.zeros(size, np.int64)
        out[group][rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    return out
