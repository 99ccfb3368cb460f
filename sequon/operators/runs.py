"""Runs of consecutive events of one kind within a key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sequon.model import counted_keys
from sequon.plans.segments import HOT, SEGMENT, SEGMENT_ROWS, Segments, plan_segments

_HIT, _PLACE, _BREAK, _CARRY = "__hit", "__place", "__break", "__carry"


def run_lengths(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    hit: Column,
    name: str = "run_length",
    segments: Segments | None = None,
    segment_rows: int = SEGMENT_ROWS,
    seen: Observation | None = None,
) -> DataFrame:
    """Add how many rows up to and including this one were hits without a break.

    A row where ``hit`` is false or null breaks the run and has length 0. ``order``
    must order the rows of a key completely. Rows without a key are left out; ``seen``
    counts them.
    """
    segments = segments or plan_segments(df, keys, order, segment_rows)
    columns = [F.col(c) for c in df.columns]
    if seen is not None:
        df = counted_keys(df, keys, seen)
    placed = segments.assign(df.withColumn(_HIT, F.coalesce(hit, F.lit(False))))
    ranked = _ranked(placed, segments)
    carry = F.lit(0)
    if segments.split:
        ranked = ranked.join(
            F.broadcast(_carried(placed.where(HOT), segments)), segments.group, "left"
        )
        carry = F.coalesce(_CARRY, F.lit(0))
    length = F.col(_PLACE) - F.coalesce(F.col(_BREAK), -carry)
    return ranked.select(*columns, length.cast("long").alias(name))


def run_alerts(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    hit: Column,
    n: int = 3,
    segments: Segments | None = None,
    segment_rows: int = SEGMENT_ROWS,
    seen: Observation | None = None,
) -> DataFrame:
    """Rows that are at least the ``n``-th hit in a row for their key."""
    if n < 1:
        raise ValueError("a run has at least one event")
    lengths = run_lengths(df, keys, order, hit, "__run", segments, segment_rows, seen)
    return lengths.where(F.col("__run") >= n).drop("__run")


def _ranked(placed: DataFrame, segments: Segments) -> DataFrame:
    """Row number in the group, and that of the last break so far."""
    rows = W.partitionBy(*segments.group).orderBy(*segments.order)
    so_far = rows.rowsBetween(W.unboundedPreceding, W.currentRow)
    return placed.withColumn(_PLACE, F.row_number().over(rows)).withColumn(
        _BREAK, F.last(F.when(~F.col(_HIT), F.col(_PLACE)), ignorenulls=True).over(so_far)
    )


def _carried(hot: DataFrame, segments: Segments) -> DataFrame:
    """Length of the run each segment of a hot key starts with."""
    summary = (
        _ranked(hot, segments)
        .groupBy(*segments.group)
        .agg(F.count("*").alias("rows"), F.max(_BREAK).alias("broke"))
    )
    earlier = (
        W.partitionBy(*segments.keys).orderBy(SEGMENT).rowsBetween(W.unboundedPreceding, -1)
    )
    summary = summary.withColumn("before", F.coalesce(F.sum("rows").over(earlier), F.lit(0)))
    broke_at = F.last(F.col("before") + F.col("broke"), ignorenulls=True).over(earlier)
    return summary.select(
        *segments.group, (F.col("before") - F.coalesce(broke_at, F.lit(0))).alias(_CARRY)
    )
