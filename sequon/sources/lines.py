"""Delimited text lines to typed sensor records.

A line is ``id,ts,vc``: split at every comma, further fields ignored, nothing
trimmed, no quoting. ``ts`` and ``vc`` are whole numbers with an optional sign that
fit 64 and 32 bits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# \z and not $, which would accept a line break at the end.
_WHOLE = r"^[+-]?[0-9]+\z"


def _record(line: str) -> tuple[Column, Column, Column]:
    """id, ts and vc; a number that is missing or wrong is null."""
    # The fourth piece is all the rest.
    fields = F.split(line, ",", 4)

    def number(at: int, kind: str) -> Column:
        field = F.get(fields, F.lit(at))
        return F.when(field.rlike(_WHOLE), field.try_cast(kind))

    return F.get(fields, F.lit(0)), number(1, "bigint"), number(2, "int")


def parse_lines(df: DataFrame, line: str = "value") -> DataFrame:
    """Records; the first bad line fails the query, whatever is read of the records."""
    name, ts, vc = _record(line)
    wrong = F.raise_error(F.concat(F.lit("not a sensor line: "), F.coalesce(line, F.lit("null"))))
    # In a filter, which column pruning cannot take away.
    good = F.when(ts.isNotNull() & vc.isNotNull(), True).otherwise(wrong.cast("boolean"))
    return df.where(good).select(name.alias("id"), ts.alias("ts"), vc.alias("vc"))


def parse_or_quarantine(df: DataFrame, line: str = "value") -> tuple[DataFrame, DataFrame]:
    """Records of the good lines, and the bad lines as they were."""
    name, ts, vc = _record(line)
    good = ts.isNotNull() & vc.isNotNull()
    records = df.where(good).select(name.alias("id"), ts.alias("ts"), vc.alias("vc"))
    return records, df.where(~good).select(line)
