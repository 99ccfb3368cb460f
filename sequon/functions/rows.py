"""Whole-row work: rendering, equality, defaults."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Text forms of the three record types, fields in schema order. A null
# field prints as null. The order form has no separator after the user.
LOGIN_FORM = (
    "LoginEvent{userId='%s', ipAddress='%s', eventType='%s', timestamp=%s, amount=%s}"
)
SENSOR_FORM = "WaterSensor{id='%s', ts=%s, vc=%s}"
ORDER_FORM = "OrderEvent{userId='%s'orderId='%s', eventType='%s', timestamp=%s}"


def render(form: str, *fields: str | Column) -> Column:
    """A record as text."""
    return F.format_string(form, *fields)


def same_row(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> Column:
    """True where two rows agree on every column, null agreeing with null."""
    same = left[columns[0]].eqNullSafe(right[columns[0]])
    for c in columns[1:]:
        same = same & left[c].eqNullSafe(right[c])
    return same


def distinct_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One of each group of equal rows, null equal to null.

    Copies are dropped before the shuffle as well as after it.
    """
    return df.select(*columns).distinct()


def with_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Fill fields a record was made without; such columns are never null."""
    return df.withColumns(
        {
            c: F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType))
            if c in df.columns
            else F.lit(v)
            for c, v in defaults.items()
        }
    )
