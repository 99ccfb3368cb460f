"""Where keys are cut."""

import pytest
from pyspark.sql import functions as F

from sequon.plans.segments import HOT, SEGMENT, plan_segments


def events(spark, rows=3000):
    """A third of the rows under one key, one time or none for many rows, some without a key."""
    return spark.range(rows).select(
        F.when(F.col("id") % 3 == 0, -1).when(F.col("id") % 100 == 1, None).otherwise(
            F.col("id") % 50
        ).alias("key"),
        F.when(F.col("id") % 11 > 0, (F.col("id") / 7).cast("int")).alias("at"),
        F.col("id").alias("tie"),
    )


def test_no_hot_key(spark):
    segments = plan_segments(events(spark), ["key"], ["at", "tie"])
    assert not segments.split
    assert segments.group == ["key"]
    assert segments.assign(events(spark)).count() == 2980


@pytest.mark.parametrize("segment_rows", [1, 10, 50, 200])
def test_every_row_has_one_segment_in_order(spark, segment_rows):
    segments = plan_segments(events(spark), ["key"], ["at", "tie"], segment_rows)
    placed = segments.assign(events(spark))
    assert placed.count() == 2980
    spans = placed.groupBy("key", SEGMENT).agg(
        F.min(F.struct("at", "tie")).alias("first"), F.max(F.struct("at", "tie")).alias("last")
    )
    by_key = {}
    for row in spans.collect():
        by_key.setdefault(row.key, []).append((row[SEGMENT], row.first, row.last))
    for parts in by_key.values():
        # Rows without a time come first.
        spans = sorted((s, [(t[0] if t[0] is not None else -1, t[1]) for t in ends]) for s, *ends in parts)
        assert all(a[1][1] < b[1][0] for a, b in zip(spans, spans[1:]))
    hot = placed.where(F.col("key") == -1)
    assert hot.where(~F.col(HOT)).isEmpty()
    largest = hot.groupBy(SEGMENT).count().agg(F.max("count")).first()[0]
    assert largest <= 3 * segment_rows


def test_cuts_are_bounded(spark):
    segments = plan_segments(events(spark), ["key"], ["at", "tie"], segment_rows=1, max_cuts=4)
    counts = [r.parts - 1 for r in segments.parts().collect()]
    assert 1 <= sum(counts) <= 4
    assert segments.all().count() == sum(counts) + len(counts)
