"""Record schemas and the checks every keyed operator makes on its input."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOGIN = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("ip_address", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("amount", T.IntegerType()),
    ]
)

ORDER = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("order_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("timestamp", T.LongType()),
    ]
)

SENSOR = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("ts", T.LongType()),
        T.StructField("vc", T.IntegerType()),
    ]
)


def has_key(keys: Sequence[str]) -> Column:
    """True where every key column is present."""
    present = F.col(keys[0]).isNotNull()
    for key in keys[1:]:
        present = present & F.col(key).isNotNull()
    return present


def split_null_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows a keyed operator can take, and the rows it refuses."""
    return df.where(has_key(keys)), df.where(~has_key(keys))


def counted_keys(
    df: DataFrame, keys: Sequence[str], seen: Observation | str, ts: str | None = None
) -> DataFrame:
    """Drop rows without a key and count both kinds in ``seen``: ``accepted``, ``rejected``.
    If ``ts`` names the time, rows without one go as well and are counted as ``untimed``.

    The counts ride along with whatever job reads the result; they cost no scan of their own,
    but conditions put on the result no longer reach the scan. A stream takes a name; its
    progress then has the counts of each micro-batch (``streaming.counts``).
    """
    named = has_key(keys)
    good, untimed = named, []
    if ts is not None:
        good = named & F.col(ts).isNotNull()
        untimed = [F.count_if(named & F.col(ts).isNull()).alias("untimed")]
    return df.observe(
        seen,
        F.count_if(good).alias("accepted"),
        F.count_if(~named).alias("rejected"),
        *untimed,
    ).where(good)
