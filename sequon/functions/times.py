"""Event time and watermarks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def event_time(millis: str | Column) -> Column:
    """Milliseconds since the epoch as a timestamp."""
    return F.timestamp_millis(millis)


def utc_time(ts: str | Column) -> Column:
    """A timestamp without time zone, taken as UTC.

    Watermarks need the zoned type; the session time zone must be UTC.
    """
    ts = F.col(ts) if isinstance(ts, str) else ts
    return ts.cast("timestamp")


def ascending(df: DataFrame, ts: str) -> DataFrame:
    """Watermark for times that never go back: just under the latest time.

    Events at the latest time itself are not late.
    """
    return df.withWatermark(ts, "1 millisecond")
