"""Two-step sequences with a time bound: A, then the next B less than T later."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sequon.model import counted_keys
from sequon.plans.segments import HOT, SEGMENT, SEGMENT_ROWS, Segments, plan_segments

# Labels of the two outputs.
MATCHED = "payed"
TIMED_OUT = "timeout"
# Neither yet, when the result is taken before the bound has passed.
PENDING = "pending"

_FIRST, _SECOND, _ROW, _NEXT, _CARRY = "__first", "__second", "__row", "__next", "__carry"


@dataclass(frozen=True)
class Step:
    name: str
    where: Column


@dataclass(frozen=True)
class Pattern:
    """``first`` followed by ``second``; rows of neither step in between are skipped.

    Every first-step row starts a match of its own and takes the next second-step
    row of its key. At exactly ``within`` the match has timed out, unless
    ``inclusive``.
    """

    first: Step
    second: Step
    within: timedelta
    inclusive: bool = False

    def __post_init__(self):
        if self.first.name == self.second.name:
            raise ValueError("step names must differ")
        if self.within <= timedelta(0):
            raise ValueError("the time bound must be positive")


def match(
    df: DataFrame,
    pattern: Pattern,
    keys: Sequence[str],
    ts: str,
    tie: str,
    keep: Sequence[str] | None = None,
    as_of: datetime | None = None,
    segments: Segments | None = None,
    segment_rows: int = SEGMENT_ROWS,
    seen: Observation | None = None,
) -> DataFrame:
    """One row per first-step row: keys, a struct per step, and ``status``.

    ``keep`` names the columns carried in the step structs. ``tie`` orders rows of
    one key and time. Without ``as_of`` the input is taken as complete; with it, the
    result is as it stood at that time: later rows are not looked at and first steps
    whose bound had not passed are pending. Rows without a key or a time are left out;
    ``seen`` counts them.
    """
    keep = list(keep) if keep is not None else df.columns
    order = [ts, tie]
    if seen is not None:
        df = counted_keys(df, keys, seen, ts)
    is_first, is_second = pattern.first.where, pattern.second.where
    if as_of is not None:
        now = F.lit(as_of.isoformat(" ")).cast(df.schema[ts].dataType)
        df = df.where(F.col(ts) <= now)
    steps = df.where((is_first | is_second) & F.col(ts).isNotNull()).select(
        *dict.fromkeys([*keys, *order, *keep]),
        F.coalesce(is_first, F.lit(False)).alias(_FIRST),
        F.coalesce(is_second, F.lit(False)).alias(_SECOND),
    )
    segments = segments or plan_segments(steps, keys, order, segment_rows)
    placed = segments.assign(steps)

    # Exchange flat columns; the structs are built on the reading side.
    rows = placed.repartition(*segments.group).withColumn(_ROW, F.struct(*keep))
    # Latest first, looking back: the frame only grows, so the last second step
    # seen is kept up to date instead of searched for per row.
    backwards = W.partitionBy(*segments.group).orderBy(*[F.desc(c) for c in order])
    later = backwards.rowsBetween(W.unboundedPreceding, -1)
    found = rows.withColumn(_NEXT, F.last(_second(ts), ignorenulls=True).over(later)).where(_FIRST)
    nearest = F.col(_NEXT)
    if segments.split:
        # The carry is as wide as the kept columns, so it is broadcast only if it
        # turns out small; otherwise it is merged with rows already in place.
        found = found.join(_carried(placed.where(HOT), segments, keep), segments.group, "left")
        nearest = F.coalesce(_NEXT, _CARRY)

    bound = F.col(ts) + F.lit(pattern.within)
    in_time = nearest["at"] <= bound if pattern.inclusive else nearest["at"] < bound
    status = F.when(in_time, MATCHED)
    if as_of is not None:
        open_still = bound >= now if pattern.inclusive else bound > now
        status = status.when(open_still, PENDING)
    return found.select(
        *keys,
        F.col(_ROW).alias(pattern.first.name),
        F.when(in_time, nearest["row"]).alias(pattern.second.name),
        status.otherwise(TIMED_OUT).alias("status"),
    )


def _second(ts: str) -> Column:
    """Time and kept columns of a second-step row, null for other rows."""
    return F.when(F.col(_SECOND), F.struct(F.col(ts).alias("at"), F.col(_ROW).alias("row")))


def _carried(hot: DataFrame, segments: Segments, keep: Sequence[str]) -> DataFrame:
    """The first second-step row after the end of each segment of a hot key."""
    heads = (
        hot.where(_SECOND)
        .withColumn(_ROW, F.struct(*keep))
        .groupBy(*segments.group)
        .agg(F.min_by(_second(segments.order[0]), F.struct(*segments.order)).alias("head"))
    )
    after = (
        W.partitionBy(*segments.keys).orderBy(F.desc(SEGMENT)).rowsBetween(W.unboundedPreceding, -1)
    )
    every = segments.all().join(heads, segments.group, "left")
    return every.select(*segments.group, F.last("head", ignorenulls=True).over(after).alias(_CARRY))


def as_map(matches: DataFrame, pattern: Pattern) -> DataFrame:
    """Replace the step structs by one map, step name to list of rows."""
    first, second = pattern.first.name, pattern.second.name
    taken = F.map_filter(
        F.create_map(F.lit(first), F.array(first), F.lit(second), F.array(second)),
        lambda name, rows: rows[0].isNotNull(),
    )
    rest = [c for c in matches.columns if c not in (first, second)]
    return matches.select(*rest, taken.alias("match"))


def step_row(match_map: Column, name: str) -> Column:
    """First row a match holds for a step; null when the step was not reached."""
    return F.get(F.try_element_at(match_map, F.lit(name)), F.lit(0))


def by_status(matches: DataFrame, status: str) -> DataFrame:
    """One of the outputs of :func:`match`."""
    return matches.where(F.col("status") == status)
