"""Columns a stateful operator holds and gives back, and which keys share a state.

Each read or write of a state is a call from Python to Spark that costs far more than a row, so
the keys of a stream are dealt, by hash, to ``BUCKETS`` states: calls grow with micro-batches, not
with keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TIMES = (T.TimestampType, T.TimestampNTZType)
BUCKET = "bucket"
#: Fixed, since a state outlives the settings of the run that began it.
BUCKETS = 128


def in_buckets(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the number of the state that a row's key belongs to."""
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int"))


def identity(values: tuple) -> tuple:
    """Equal for keys that Spark groups together; what is not a number equals itself."""
    return tuple(_plain_value(v) if v != v or not isinstance(v, (int, str)) else v for v in values)


def _plain_value(value: object) -> object:
    if isinstance(value, (bytes, bytearray)):
        return bytes(value)
    if isinstance(value, float):
        return value if value == value else "NaN"
    return repr(value) if isinstance(value, (list, tuple, dict)) else value


def plain(df: DataFrame, name: str) -> Column:
    """A column as state holds it: times as microseconds, free of time zones."""
    if isinstance(df.schema[name].dataType, TIMES):
        return F.unix_micros(F.col(name).cast("timestamp"))
    return F.col(name)


def typed(df: DataFrame, name: str, value: Column) -> Column:
    """Undo :func:`plain`."""
    kind = df.schema[name].dataType
    return F.timestamp_micros(value).cast(kind) if isinstance(kind, TIMES) else value
