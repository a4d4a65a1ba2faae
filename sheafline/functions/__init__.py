"""Column-level helpers shared by the operators."""

from sheafline.functions.dates import (
    calendar_year,
    cyclic,
    date_literal,
    iso_week,
    monday_weekday,
    sunday_weekday,
)
from sheafline.functions.numeric import as_int, as_long, percent_error, ratio
from sheafline.functions.seasons import harvest_season, planting_season, season_day
from sheafline.functions.trailing import TrailingSum, trailing_sums

__all__ = [
    "TrailingSum",
    "as_int",
    "as_long",
    "calendar_year",
    "cyclic",
    "date_literal",
    "harvest_season",
    "iso_week",
    "monday_weekday",
    "percent_error",
    "planting_season",
    "ratio",
    "season_day",
    "sunday_weekday",
    "trailing_sums",
]
