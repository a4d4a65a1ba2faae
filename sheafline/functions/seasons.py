"""Season buckets.

A harvest season runs from 1 September to 31 August and is named after its first year.
A planting season runs from 15 May to 14 May and is named after its last year. Both
have an open first season that swallows everything before 1 September 2016.

Fixed values: the first season is 2015 and ends on 2016-08-31; planting seasons are
known up to 2022, harvest seasons up to 2023 (2022, open-ended, in the weekly features).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

FIRST_SEASON = 2015
FIRST_SEASON_END = dt.date(2016, 9, 1)
LAST_PLANTING_SEASON = 2022
LAST_HARVEST_SEASON = 2023
LAST_WEEKLY_SEASON = 2022
SEASON_START_DAY = 244


def harvest_season(day: Column, *, last: int = LAST_HARVEST_SEASON, open_ended: bool = False) -> Column:
    """Season of a delivery date; beyond ``last`` it is NULL, or ``last`` if open-ended."""
    # eight months back, 1 September becomes 1 January
    season = F.year(F.add_months(day, -8))
    beyond = F.lit(last) if open_ended else F.lit(None).cast("int")
    return (
        F.when(day < F.lit(FIRST_SEASON_END), F.lit(FIRST_SEASON))
        .when(season > last, beyond)
        .otherwise(season)
    )


def planting_season(day: Column, *, last: int = LAST_PLANTING_SEASON) -> Column:
    """Season of a planting date; NULL beyond ``last``.

    The open first season wins over the 15 May rule, so May-August 2016 is 2015.
    """
    # fourteen days and four months back, 15 May becomes 1 January
    season = F.year(F.add_months(F.date_sub(day, 14), -4)) + F.lit(1)
    return F.when(day < F.lit(FIRST_SEASON_END), F.lit(FIRST_SEASON)).when(season <= last, season)


def season_day(day: Column) -> Column:
    """Days since 1 September, counted in years of 365 days."""
    doy = F.dayofyear(day)
    return F.when(doy < SEASON_START_DAY, doy + F.lit(365)).otherwise(doy) - F.lit(SEASON_START_DAY)
