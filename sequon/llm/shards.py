"""Shards of near equal bytes by sampled splitters.

Rows are ordered by a hash of their text, so that copies lie together. A sample of keys
weighted by size gives the splitters of many small ranges; the bytes of each range are then
counted over all rows, and a range with more than its part, a large group of copies for
one, is subdivided by row. Exact running sums within ranges and the totals of those before
cut the whole order into shards. Only ids, sizes and hashes move.

A null text has 16 bytes and checksum null, an empty one 16 and 0; repeated rows take slots
of their own. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sequon.llm.common import kept

#: Ranges aimed at for each shard.
RANGES_PER_SHARD = 8
#: Sampled keys for each range.
SAMPLES_PER_RANGE = 8


def _splitters(rows: DataFrame, total: int, ranges: int) -> np.ndarray:
    """Quantiles of a sample in which a row's chance follows its size; bounded in size."""
    wanted = ranges * SAMPLES_PER_RANGE
    chance = F.least(F.lit(1.0), F.col("size") * F.lit(wanted / max(total, 1)))
    draw = F.pmod(F.xxhash64("at", F.lit(1)), F.lit(1 << 30)) / (1 << 30)
    # About `wanted` rows by the choice of chance.
    keys = np.sort(rows.where(draw < chance).select("key").toPandas()["key"].to_numpy(np.int64))
    if not len(keys):
        return keys
    return np.unique(keys[np.linspace(0, len(keys) - 1, ranges + 1).astype(int)[1:-1]])


def assign(docs: DataFrame, shards: int = 40) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row; other columns are left out."""
    rows = kept(
        docs.select(
            "doc_id",
            (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
            F.crc32("text").alias("text_crc32"),
            F.xxhash64("text").alias("key"),
            F.monotonically_increasing_id().alias("at"),
        )
    )
    total = rows.agg(F.sum("size")).first()[0] or 0
    ranges = shards * RANGES_PER_SHARD
    sent = rows.sparkSession.sparkContext.broadcast(_splitters(rows, total, ranges))

    @F.pandas_udf("int")
    def range_of(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(sent.value, key.to_numpy(np.int64), side="right"))

    placed = kept(rows.withColumn("range", range_of("key")))
    sums = placed.groupBy("range").agg(F.sum("size").alias("bytes"))
    part = max(total // ranges, 1)
    pieces = sums.select("range", F.ceil(F.col("bytes") / (2 * part)).alias("pieces"))
    # One row per range: at most `ranges`.
    cut = kept(
        placed.join(F.broadcast(pieces), "range").withColumn(
            "piece", F.pmod(F.xxhash64("at", F.lit(2)), "pieces")
        )
    )
    # Pieces hold about two parts each, so there are no more than 1.5 times as many as ranges.
    offsets = cut.groupBy("range", "piece").agg(F.sum("size").alias("b")).toPandas()
    offsets = offsets.sort_values(["range", "piece"], ignore_index=True)
    offsets["before"] = offsets["b"].cumsum() - offsets["b"]
    spark = rows.sparkSession
    before = spark.createDataFrame(
        [tuple(map(int, r)) for r in offsets[["range", "piece", "before"]].to_numpy()],
        "range int, piece long, before long",
    )
    order = Window.partitionBy("range", "piece").orderBy("key", "at")
    middle = F.col("before") + F.sum("size").over(order) - F.col("size") / 2
    shard = F.least(F.floor(middle * shards / F.lit(max(total, 1))), F.lit(shards - 1)).cast("int")
    sharded = kept(cut.join(F.broadcast(before), ["range", "piece"]).withColumn("shard", shard))
    # A shard's pieces and their rows: about as many as there are pieces and shards.
    held = sharded.groupBy("shard", "range", "piece").agg(F.count("*").alias("n")).toPandas()
    held = held.sort_values(["shard", "range", "piece"], ignore_index=True)
    held["first"] = held.groupby("shard")["n"].cumsum() - held["n"]
    first = spark.createDataFrame(
        [tuple(map(int, r)) for r in held[["shard", "range", "piece", "first"]].to_numpy()],
        "shard int, range int, piece long, first long",
    )
    within = Window.partitionBy("shard", "range", "piece").orderBy("key", "at")
    slot = F.col("first") + F.row_number().over(within) - 1
    return sharded.join(F.broadcast(first), ["shard", "range", "piece"]).select(
        "doc_id", "size", "text_crc32", "shard", slot.cast("long").alias("slot")
    )


def write(docs: DataFrame, assigned: DataFrame, path: str) -> None:
    """One folder per shard, rows by slot; ``doc_id`` must be unique."""
    rows = docs.join(assigned.select("doc_id", "shard", "slot"), "doc_id")
    files = rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    files.write.partitionBy("shard").parquet(path)
