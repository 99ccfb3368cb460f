"""Which tasks the steps of a hot key go to, for as long as a stream lives.

The first steps of a hot key are dealt out to several tasks by stretches of time, its second steps
are copied to those whose first steps they may close, a number that the bound settles, not the
plan. How many tasks is planned on past rows and may change whenever the stream is started
anew, while steps dealt out by an earlier plan still wait in the state. So plans are kept, one
version after the other, beside the checkpoint. A version holds for event times later than any
the stream had seen when it was added; where a step goes follows from its time and the versions
alone, whichever run it arrives in.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sequon.plans.segments import Segments

_PARTS, _SINCE, _UNTIL, _VERSION, _ROUTES = "parts", "since", "until", "version", "__routes"
#: Before and after all times, in microseconds.
_EVER, _NEVER = -(2**62), 2**62
#: Stretches of time in a bound; a second step has at most two copies more than that.
STRETCHES = 4


def _read(spark: SparkSession, path: str, reader: str = "parquet") -> DataFrame | None:
    try:
        return spark.read.format(reader).load(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def _seen(spark: SparkSession, checkpoint: str, delay: str) -> int | None:
    """The latest time, in microseconds, that a stream can have seen; None if it never ran.

    Each committed micro-batch says what the watermark became, which is that time less the
    delay, whole milliseconds.
    """
    commits = _read(spark, f"{checkpoint}/commits/*", "text")
    if commits is None:
        return None
    at = F.get_json_object("value", "$.nextBatchWatermarkMs").cast("long")
    after = F.expr(f"unix_micros(timestamp_micros(0) + INTERVAL {delay})")
    row = commits.agg(F.max(at).alias("at")).select("at", after.alias("delay")).first()
    return None if row["at"] is None else (row["at"] + 1) * 1000 + row["delay"]


def plan_routes(
    spark: SparkSession,
    checkpoint: str,
    keys: Sequence[str],
    segments: Segments | None,
    delay: str = "1 millisecond",
    within: timedelta | None = None,
) -> DataFrame:
    """All versions of the routes of a stream, ``segments`` the latest: for ``match_stream``.

    Call it before each start with the checkpoint the stream will use and its watermark delay.
    A version is added only if the plan differs from the last one. Versions so old that no
    open step can be theirs, ``within`` behind, are left out of the result.
    """
    keys, folder = list(keys), f"{checkpoint.rstrip('/')}-routes"
    seen = _seen(spark, checkpoint.rstrip("/"), delay)
    split = segments is not None and segments.split
    kept = _read(spark, folder)
    if kept is None:
        if not split and seen is None:
            return _versions(spark, None, keys)
        latest = None
    else:
        last = kept.agg(F.max(_VERSION)).first()[0]
        newest = W.partitionBy(*keys).orderBy(F.desc(_VERSION))
        now = kept.withColumn("n", F.row_number().over(newest)).where("n = 1")
        latest = now.where(F.col(_PARTS) > 1).select(*keys, _PARTS)
    wanted = segments.parts().select(*keys, _PARTS) if split else None
    if latest is None:
        change = wanted
    elif wanted is None:
        change = latest.withColumn(_PARTS, F.lit(1))
    else:
        both = latest.withColumnRenamed(_PARTS, "before").join(wanted, keys, "full")
        after = F.coalesce(_PARTS, F.lit(1))
        change = both.where(~F.col("before").eqNullSafe(after)).select(*keys, after.alias(_PARTS))
    if change is not None:
        version = 0 if kept is None else last + 1
        since = _EVER if seen is None else seen
        added = change.select(
            *keys, F.col(_PARTS).cast("int").alias(_PARTS), F.lit(since).alias(_SINCE)
        )
        # Few rows: hot keys whose plan has changed.
        added.coalesce(1).write.mode("overwrite").parquet(f"{folder}/{_VERSION}={version}")
    oldest = None
    if within is not None and seen is not None:
        oldest = seen - 2 * (within // timedelta(microseconds=1))
    return _versions(spark, _read(spark, folder), keys, oldest)


def _versions(
    spark: SparkSession, rows: DataFrame | None, keys: list[str], oldest: int | None = None
) -> DataFrame:
    """One row per key: its versions as (since, until, parts), in order."""
    if rows is None:
        return spark.createDataFrame([], "none int")
    after = W.partitionBy(*keys).orderBy(_VERSION)
    spans = rows.withColumn(
        _UNTIL, F.coalesce(F.lead(_SINCE).over(after), F.lit(_NEVER))
    ).where(F.col(_UNTIL) > (_EVER if oldest is None else oldest))
    span = F.struct(_SINCE, _UNTIL, _PARTS)
    return spans.groupBy(*keys).agg(F.array_sort(F.collect_list(span)).alias(_ROUTES))


def fixed_routes(segments: Segments) -> DataFrame:
    """One plan for all times, for a stream that is never started again with another."""
    span = F.struct(
        F.lit(_EVER).alias(_SINCE), F.lit(_NEVER).alias(_UNTIL), F.col(_PARTS).cast("int").alias(_PARTS)
    )
    parts = segments.parts()
    return parts.select(*[c for c in parts.columns if c != _PARTS], F.array(span).alias(_ROUTES))


def has_routes(routes: DataFrame | None) -> bool:
    return routes is not None and _ROUTES in routes.columns


def dealt(
    steps: DataFrame,
    routes: DataFrame,
    keys: list[str],
    ts: str,
    tie: str,
    second: Column,
    within: timedelta,
) -> tuple[DataFrame, Column, Column]:
    """Rows with the tasks of their key they go to, that task, and whether the row may start
    a match there.

    First steps go to a task by their stretch of time, a ``STRETCHES``-th of the bound. A second
    step goes wherever a first step that is still open may be: to the tasks of the stretches since
    the bound began, however many tasks there are. A row that is both steps starts its match in one
    task. Hot keys are at most as many as a plan has cuts.
    """
    parted = steps.join(F.broadcast(routes), keys, "left")
    at, bound = F.unix_micros(ts), within // timedelta(microseconds=1)
    spans = F.coalesce(_ROUTES, F.array().cast("array<struct<since:bigint,until:bigint,parts:int>>"))

    def place(time: Column) -> Column:
        return F.floor(time / max(1, bound // STRETCHES)).cast("long")

    def holding(begin: Column) -> Column:
        """The versions that hold from ``begin`` to the row's time."""
        return F.filter(spans, lambda v: (v[_SINCE] <= at) & (v[_UNTIL] > begin))

    def part(slot: Column, version: Column) -> Column:
        return F.pmod(slot, version[_PARTS]).cast("int")

    mine = F.coalesce(F.get(F.transform(holding(at), lambda v: part(place(at), v)), F.lit(0)), F.lit(0))
    begin = at - bound - 1
    slots = F.sequence(place(begin), place(at))
    open_in = F.flatten(
        F.transform(holding(begin), lambda v: F.transform(slots, lambda slot: part(slot, v)))
    )
    # Where no version held yet, first steps went to task 0.
    unplanned = F.when(F.exists(spans, lambda v: v[_SINCE] <= begin), F.array().cast("array<int>"))
    before = F.coalesce(unplanned, F.array(F.lit(0)))
    to = F.when(second, F.array_union(open_in, before)).otherwise(F.array("__mine"))
    salted = parted.withColumn("__mine", mine).withColumn("__salt", F.explode(to))
    return salted, F.col("__salt"), F.col("__salt") == F.col("__mine")
