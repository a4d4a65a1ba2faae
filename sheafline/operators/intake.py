"""Daily and weekly intake tables: deliveries, calendar and trailing weather.

The daily and weekly tables exist for one site or for many. Deliveries are shared, the
weather is the site's own. With many sites every window stays inside a site, so sites
run in parallel; the single-site form is the same plan with one site.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from sheafline.functions import (
    TrailingSum,
    as_int,
    as_long,
    calendar_year,
    date_literal,
    iso_week,
    trailing_sums,
)
from sheafline.functions.dates import as_date

DELIVERY_COLUMNS = ["date_recolte", "code_adherent", "quantite_recolte"]

# fixed values: rows before the current one in the trailing weather sums
WEATHER_SUMS = (
    TrailingSum("tmax", "cumultmax", start=38, end=0),
    TrailingSum("tmin", "cumultmin", start=28, end=0),
    TrailingSum("rr10", "cumulrr10", start=28, end=0),
)

DAY_START = dt.date(2016, 2, 5)
WEEK_START = dt.date(2016, 2, 8)
RUN_START = dt.date(2016, 2, 11)


def deliveries_union(archive: DataFrame, live: DataFrame) -> DataFrame:
    """All archived and live deliveries; other archive columns are NULL for live rows."""
    return archive.unionByName(live.select(*DELIVERY_COLUMNS), allowMissingColumns=True)


def daily_intake(deliveries: DataFrame) -> DataFrame:
    """Delivered quantity per day."""
    return deliveries.groupBy("date_recolte").agg(F.sum("quantite_recolte").alias("quantite_recolte"))


def calendar_between(
    spark: SparkSession, start: dt.date | str, end: dt.date | str, *, skip_sunday: bool = True
) -> DataFrame:
    """Calendar table for a range of days, for users who have none."""
    first, last = as_date(start), as_date(end)
    days = spark.range((last - first).days + 1).select(
        F.date_add(F.lit(first), F.col("id").cast("int")).alias("jour")
    )
    return days.filter(F.dayofweek("jour") > 1) if skip_sunday else days


def calendar_spine(calendar: DataFrame, daily: DataFrame) -> DataFrame:
    """Calendar days with their intake; a day without intake keeps NULL."""
    days = calendar.select(F.col("jour").alias("date_recolte"))
    return days.join(daily, "date_recolte", "left").select("date_recolte", "quantite_recolte")


def weather_trailing(weather: DataFrame, *, sites: Sequence[int] | None = None) -> DataFrame:
    """Weather with its three trailing sums, the current day included."""
    if sites is not None:
        weather = weather.filter(F.col("code_insee").isin(list(sites)))
    base = weather.select("code_insee", "date_reelle", "tmin", "tmax", "rr10")
    return trailing_sums(base, ["code_insee"], "date_reelle", WEATHER_SUMS)


def site_days(
    archive: DataFrame,
    live: DataFrame,
    calendar: DataFrame,
    weather: DataFrame,
    *,
    sites: Sequence[int],
) -> DataFrame:
    """Calendar days x sites with shared intake and the site's weather.

    The common base of the daily and the weekly feature table. A run that needs both
    can build it once, keep it, and read the deliveries once.
    """
    intake = calendar_spine(calendar, daily_intake(deliveries_union(archive, live)))
    site = F.explode(F.array(*(F.lit(s).cast("bigint") for s in sites)))
    spine = intake.withColumn("code_insee", site)
    observed = weather_trailing(weather, sites=sites).withColumnRenamed("date_reelle", "date_recolte")
    return spine.join(observed, ["code_insee", "date_recolte"], "left")


def day_table(days: DataFrame, *, start: dt.date | str = DAY_START) -> DataFrame:
    """Daily feature table from ``site_days``, keyed (code_insee, jour); not sorted."""
    return days.filter(F.col("date_recolte") > date_literal(start)).select(
        "code_insee",
        F.col("date_recolte").alias("jour"),
        as_long(days, "quantite_recolte").alias("qte"),
        as_int(days, "tmin").alias("t_min"),
        as_int(days, "tmax").alias("t_max"),
        as_int(days, "cumultmax").alias("ctmax"),
        as_int(days, "cumultmin").alias("ctmin"),
        as_int(days, "cumulrr10").alias("cpluie"),
    )


def flux_day_sites(
    archive: DataFrame,
    live: DataFrame,
    calendar: DataFrame,
    weather: DataFrame,
    *,
    sites: Sequence[int],
    start: dt.date | str = DAY_START,
) -> DataFrame:
    """Daily feature table of several sites; not sorted."""
    return day_table(site_days(archive, live, calendar, weather, sites=sites), start=start)


def flux_day(
    archive: DataFrame,
    live: DataFrame,
    calendar: DataFrame,
    weather: DataFrame,
    *,
    site: int,
    start: dt.date | str = DAY_START,
) -> DataFrame:
    """Daily feature table of one site, in day order."""
    days = flux_day_sites(archive, live, calendar, weather, sites=[site], start=start)
    return days.drop("code_insee").orderBy("jour")


def week_table(days: DataFrame, *, start: dt.date | str = WEEK_START) -> DataFrame:
    """Weekly feature table from ``site_days``, keyed (code_insee, id); not sorted.

    Daily measures are rounded before the weekly sum, trailing sums after it. Weeks are
    numbered per site before weeks without weather are dropped, so numbers can have
    gaps.
    """
    days = days.filter(F.col("date_recolte") >= date_literal(start))
    rounded = days.select(
        "code_insee",
        calendar_year(days["date_recolte"]).alias("an"),
        iso_week(days["date_recolte"]).alias("sem"),
        as_long(days, "quantite_recolte").alias("qte"),
        as_int(days, "tmin").alias("t_min"),
        as_int(days, "tmax").alias("t_max"),
        as_int(days, "rr10").alias("pluie"),
        F.col("cumultmax").alias("ctmax"),
        F.col("cumultmin").alias("ctmin"),
        F.col("cumulrr10").alias("cpluie"),
    )
    measures = ["qte", "t_min", "t_max", "pluie", "ctmax", "ctmin", "cpluie"]
    weekly = rounded.groupBy("code_insee", "an", "sem").agg(*(F.sum(m).alias(m) for m in measures))
    numbered = weekly.withColumn(
        "id", F.row_number().over(Window.partitionBy("code_insee").orderBy("an", "sem"))
    )
    return numbered.filter(F.col("t_min").isNotNull()).select(
        "code_insee",
        "id",
        "sem",
        "an",
        as_long(numbered, "qte"),
        *(as_int(numbered, m) for m in measures[1:]),
    )


def flux_week_sites(
    archive: DataFrame,
    live: DataFrame,
    calendar: DataFrame,
    weather: DataFrame,
    *,
    sites: Sequence[int],
    start: dt.date | str = WEEK_START,
) -> DataFrame:
    """Weekly feature table of several sites; not sorted."""
    return week_table(site_days(archive, live, calendar, weather, sites=sites), start=start)


def flux_week(
    archive: DataFrame,
    live: DataFrame,
    calendar: DataFrame,
    weather: DataFrame,
    *,
    site: int,
    start: dt.date | str = WEEK_START,
) -> DataFrame:
    """Weekly feature table of one site, in week order."""
    weeks = flux_week_sites(archive, live, calendar, weather, sites=[site], start=start)
    return weeks.drop("code_insee").orderBy("an", "sem")


def flux_day_until(
    flux: DataFrame,
    *,
    as_of: dt.date | str,
    start: dt.date | str = RUN_START,
    horizon: int = 10,
) -> DataFrame:
    """Days of a daily feature table from ``start`` to ``as_of + horizon``."""
    end = as_date(as_of) + dt.timedelta(days=horizon)
    return flux.filter(F.col("jour").between(date_literal(start), F.lit(end)))


def flux_week_until_next(flux: DataFrame, *, as_of: dt.date | str) -> DataFrame:
    """Weeks of a weekly feature table up to the week after ``as_of``.

    The last week is found by its number, so that the numbering order decides. A table
    that does not reach the next week gives no rows.
    """
    upcoming = (as_date(as_of) + dt.timedelta(days=7)).isocalendar()
    wanted = (F.col("an") == upcoming.year) & (F.col("sem") == upcoming.week)
    keys = [c for c in ("code_insee",) if c in flux.columns]
    # one pass over the weeks; their number is bounded by the calendar
    last = F.max(F.when(wanted, F.col("id"))).over(Window.partitionBy(*keys))
    return flux.withColumn("__last", last).filter(F.col("id") <= F.col("__last")).drop("__last")
