"""Calendar expressions.

Weekly keys pair the ISO week with the *calendar* year, so 2021-01-01 is week 53 of
2021 and shares nothing with December 2020.
"""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import Column, functions as F


def date_literal(value: dt.date | str) -> Column:
    """A date parameter, given as a date or as 'YYYY-MM-DD'."""
    return F.lit(as_date(value))


def as_date(value: dt.date | str) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(value)


def iso_week(day: Column) -> Column:
    return F.weekofyear(day)


def calendar_year(day: Column) -> Column:
    return F.year(day)


def sunday_weekday(day: Column) -> Column:
    """Weekday with Sunday = 0."""
    return F.dayofweek(day) - F.lit(1)


def monday_weekday(day: Column) -> Column:
    """Weekday with Monday = 0."""
    return F.weekday(day)


def cyclic(wave: str, position: Column, period: float) -> Column:
    """``sin`` or ``cos`` of a position on a cycle of the given period."""
    angle = position.cast("double") * F.lit(2.0 * math.pi / period)
    return {"sin": F.sin, "cos": F.cos}[wave](angle)
