"""Rounding and division with the semantics of a SQL database.

Spark's ``cast`` truncates. A database cast to an integer rounds: binary floats half
to even, exact numerics half away from zero. ``as_int``/``as_long`` pick the rule from
the column's type.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DecimalType, DoubleType, FloatType


def _to_integer(df: DataFrame, name: str, width: str) -> Column:
    kind = df.schema[name].dataType
    value = df[name]
    if isinstance(kind, (DoubleType, FloatType)):
        value = F.rint(value)
    elif isinstance(kind, DecimalType):
        value = F.round(value, 0)
    return value.cast(width).alias(name)


def as_int(df: DataFrame, name: str) -> Column:
    """Column ``name`` of ``df`` rounded to a 32-bit integer, same name."""
    return _to_integer(df, name, "int")


def as_long(df: DataFrame, name: str) -> Column:
    """Column ``name`` of ``df`` rounded to a 64-bit integer, same name.

    Used for every sum over deliveries or plantings, whose size grows with the data.
    """
    return _to_integer(df, name, "bigint")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division that gives NULL, not an error, on a zero denominator."""
    bottom = denominator.cast("double")
    return numerator.cast("double") / F.when(bottom != 0, bottom)


def percent_error(predicted: Column, actual: Column) -> Column:
    """Absolute percentage error rounded half away from zero to two places.

    The rounding runs on a decimal, as binary halves such as 12.345 would else depend
    on the engine.
    """
    raw = ratio(F.abs(predicted - actual), actual) * F.lit(100.0)
    return F.round(raw.cast("decimal(30,10)"), 2).cast("double")
