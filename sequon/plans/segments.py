"""Cutting hot keys into ordered segments.

The keyed operators need the rows of a key in order. A window over the key alone
gives one task every row of the hottest key, so keys with more than about
``segment_rows`` rows are cut, in order, into segments. Each operator then works
on (key, segment), boils a segment of a hot key down to one small row, carries
those rows forward along the key, and adds the carried value back to the rows.

Cuts come from a hash sample, as the bounds of a range sort do. A poor sample only
makes segments uneven: every row has exactly one segment and segments follow the
order of the rows, so results do not depend on where the cuts fall.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sequon.model import has_key

# Rows of one key that one task may hold.
SEGMENT_ROWS = 2_000_000
# Most cuts over all keys, and so the size of what is collected and broadcast.
MAX_CUTS = 20_000
# Sampled rows per segment; at most MARKS * MAX_CUTS of them are ever sorted.
MARKS = 32

SEGMENT = "__segment"
HOT = "__hot"
_CUTS = "__cuts"
_MARK, _HASH = "__mark", "__hash"


@dataclass(frozen=True)
class Segments:
    """Where hot keys are cut. ``cuts`` is None when no key is hot."""

    keys: tuple[str, ...]
    order: tuple[str, ...]
    cuts: DataFrame | None = None
    longest: int = 0

    @property
    def split(self) -> bool:
        return self.cuts is not None

    @property
    def group(self) -> list[str]:
        """Columns whose groups are small enough for one task."""
        return [*self.keys, SEGMENT] if self.split else list(self.keys)

    def assign(self, df: DataFrame) -> DataFrame:
        """Drop rows without a key; where keys are cut, add the segment number.

        The broadcast side has at most ``MAX_CUTS`` cut points. The cut lists stay
        on the map side: only the segment number is shuffled.
        """
        df = df.where(has_key(self.keys))
        if not self.split:
            return df
        columns = [F.col(c) for c in df.columns]
        placed = df.join(F.broadcast(self.cuts), list(self.keys), "left").withColumns(
            {
                HOT: F.col(_CUTS).isNotNull(),
                _MARK: F.struct(*self.order),
                SEGMENT: F.lit(0),
            }
        )
        # Binary search for the number of cuts at or before the row. Steps are written
        # out so that they become generated code; a lambda would be interpreted.
        for bit in reversed(range(self.longest.bit_length())):
            further = F.col(SEGMENT) + (1 << bit)
            passed = F.col(HOT) & (F.get(_CUTS, further - 1) <= F.col(_MARK))
            placed = placed.withColumn(SEGMENT, F.when(passed, further).otherwise(F.col(SEGMENT)))
        return placed.select(*columns, SEGMENT, HOT)

    def all(self) -> DataFrame:
        """Every segment of every hot key, by number."""
        return self.cuts.select(
            *self.keys, F.explode(F.sequence(F.lit(0), F.size(_CUTS))).alias(SEGMENT)
        )

    def parts(self) -> DataFrame:
        """Every hot key and how many segments it has."""
        return self.cuts.select(*self.keys, (F.size(_CUTS) + 1).alias("parts"))


def plan_segments(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    segment_rows: int = SEGMENT_ROWS,
    max_cuts: int = MAX_CUTS,
) -> Segments:
    """Find hot keys and cut them; runs one narrow scan of key and order columns.

    Keys are flagged from about ``MARKS`` sampled rows per segment, so the scan
    shuffles a few rows per million. The result can be passed to several operators
    that share keys and order.
    """
    keys, order = tuple(keys), tuple(order)
    stride = max(1, segment_rows // MARKS)
    marks = (
        df.where(has_key(keys))
        .select(
            *keys,
            F.struct(*order).alias(_MARK),
            F.xxhash64(*keys, *order).alias(_HASH),
        )
        .where(F.pmod(_HASH, F.lit(stride)) == 0)
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    try:
        total = marks.count()
        if total < segment_rows // stride:
            return Segments(keys, order)
        thinned = marks
        if total > MARKS * max_cuts:
            # Multiples of a multiple of the stride: a sample of the sample.
            stride *= -(-total // (MARKS * max_cuts))
            thinned = marks.where(F.pmod(_HASH, F.lit(stride)) == 0)
            total = thinned.count()
        # Every step-th mark of a key is a cut, so all keys together get at most
        # total / step of them.
        step = max(1, segment_rows // stride, -(-total // max_cuts))
        place = F.row_number().over(W.partitionBy(*keys).orderBy(_MARK))
        found = (
            thinned.withColumn("__place", place)
            .where(F.col("__place") % step == 0)
            .groupBy(*keys)
            .agg(F.collect_list(_MARK).alias(_CUTS))
        )
        cuts = found.collect()
    finally:
        marks.unpersist()
    if not cuts:
        return Segments(keys, order)
    table = df.sparkSession.createDataFrame(cuts, found.schema)
    return Segments(
        keys,
        order,
        table.withColumn(_CUTS, F.array_sort(_CUTS)),
        max(len(row[_CUTS]) for row in cuts),
    )
