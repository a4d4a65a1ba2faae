"""Weekly profiles and forecast-versus-actual reports.

All deliveries are reduced to one row per day first; weeks, holidays and counts are
then built from that calendar-sized table, so the fact table is read once.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, FloatType

from sheafline.functions import (
    as_int,
    as_long,
    calendar_year,
    date_literal,
    iso_week,
    percent_error,
    ratio,
)

WEEK = ["annee", "semaine"]
REPORT_START = dt.date(2019, 9, 9)
REPORT_COUNT_YEAR = 2019


def _week_of(day: str) -> list[Column]:
    return [calendar_year(F.col(day)).alias("annee"), iso_week(F.col(day)).alias("semaine")]


def weekly_delivery_count(deliveries: DataFrame) -> DataFrame:
    """Number of deliveries with a known grower, per week."""
    return deliveries.groupBy(*_week_of("date_recolte")).agg(F.count("code_adherent").alias("nbr_apports"))


def weekly_weather(weather: DataFrame, *, site: int) -> DataFrame:
    """Summed temperatures and rain of one site, per week."""
    return (
        weather.filter(F.col("code_insee") == site)
        .groupBy(*_week_of("date_reelle"))
        .agg(*(F.sum(m).alias(m) for m in ("tmax", "tmin", "rr10")))
    )


def weekly_worked_holidays(holidays: DataFrame, deliveries: DataFrame, *, as_of: dt.date | str) -> DataFrame:
    """Public holidays with deliveries, per week that has a holiday; NULL if none was worked."""
    days = holidays.filter(F.col("jour") <= date_literal(as_of)).select("jour").distinct()
    received = deliveries.groupBy(F.col("date_recolte").alias("jour")).agg(
        F.sum("quantite_recolte").alias("received")
    )
    worked = F.when(F.col("received").isNotNull(), F.lit(1))
    return (
        days.join(received, "jour", "left")
        .groupBy(*_week_of("jour"))
        .agg(F.sum(worked).alias("nb_jr_ferie"))
    )


def weekly_profile(
    deliveries: DataFrame,
    weather: DataFrame,
    holidays: DataFrame,
    *,
    as_of: dt.date | str,
    site: int,
    annee: int,
    semaine: int,
    mode: str,
) -> DataFrame:
    """Weather weeks with delivery counts and worked holidays.

    Mode ``predict`` gives the one week; any other mode gives the weeks that are at most
    ``semaine`` in years that are at most ``annee`` (two separate bounds).
    """
    year, week = F.col("annee"), F.col("semaine")
    daily = deliveries.groupBy("date_recolte").agg(
        F.count("code_adherent").alias("n"), F.sum("quantite_recolte").alias("received")
    )
    holiday = (
        holidays.filter(F.col("jour") <= date_literal(as_of))
        .select(F.col("jour").alias("date_recolte"), F.lit(True).alias("holiday"))
        .distinct()
    )
    worked = F.when(F.col("holiday") & F.col("received").isNotNull(), F.lit(1))
    # a holiday without deliveries counts as 0 in the end, so delivery days suffice
    intake = (
        daily.join(holiday, "date_recolte", "left")
        .groupBy(*_week_of("date_recolte"))
        .agg(F.sum("n").alias("nombre_apports"), F.sum(worked).alias("worked"))
    )
    profile = weekly_weather(weather, site=site).join(intake, WEEK, "left")
    profile = profile.select(
        F.col("semaine").alias("week"),
        F.col("annee").alias("season"),
        "nombre_apports",
        F.coalesce("worked", F.lit(0)).cast("int").alias("nombre_jours_feries"),
        as_int(profile, "tmin").alias("t_min"),
        as_int(profile, "tmax").alias("t_max"),
        F.col("rr10").cast("double").alias("pluie"),
    )
    year, week = F.col("season"), F.col("week")
    if mode == "predict":
        return profile.filter((year == annee) & (week == semaine))
    return profile.filter((year <= annee) & (week <= semaine)).orderBy("season", "week")


def _weekly_sum(df: DataFrame, day: str, value: str, name: str, since: dt.date | str | None) -> DataFrame:
    if since is not None:
        df = df.filter(F.col(day) >= date_literal(since))
    return df.groupBy(*_week_of(day)).agg(F.sum(value).alias(name))


def weekly_forecast_error(
    forecast: DataFrame,
    deliveries: DataFrame,
    counts: DataFrame,
    weather: DataFrame,
    *,
    site: int,
    mode: str,
    annee: int | None = None,
    semaine: int | None = None,
    since: dt.date | str = REPORT_START,
    count_year: int = REPORT_COUNT_YEAR,
) -> DataFrame:
    """Weekly forecast against actual intake, with delivery counts and weather.

    ``dif_tmin``/``dif_tmax`` carry the value of the previous row in (week, year) order,
    that is the same week of the year before. Mode ``predict`` keeps one week.
    """
    predicted = _weekly_sum(forecast, "jour", "dt", "rf", since)
    actual = _weekly_sum(deliveries, "date_recolte", "quantite_recolte", "reel", since)
    expected = counts.filter((F.col("annee") >= count_year) & F.col("apports_predits").isNotNull())
    # a row per week: bounded by the calendar, so one task may order it
    order = Window.orderBy("semaine", "annee")
    sky = weekly_weather(weather, site=site).select(
        *WEEK,
        "tmin",
        "tmax",
        F.lag("tmin").over(order).alias("dif_tmin"),
        F.lag("tmax").over(order).alias("dif_tmax"),
    )
    report = (
        predicted.join(expected, WEEK)
        .join(actual, WEEK, "left")
        .join(sky.withColumn("sky", F.lit(True)), WEEK, "left")
    )
    said, told = F.col("apports_predits"), F.col("apports_reportes")
    observed = F.col("sky")
    report = report.select(
        # week and year are the weather table's, NULL where it has no such week
        F.when(observed, F.col("annee")).alias("saison"),
        F.when(observed, F.col("semaine")).alias("sem"),
        as_long(report, "rf").alias("pred"),
        as_long(report, "reel").alias("qte_recolte"),
        percent_error(F.col("rf"), F.col("reel")).alias("er_pct"),
        F.abs(said - told).alias("dif_apports"),
        F.abs(ratio(told - said, said)).alias("quotient_apports"),
        said.alias("app_predits"),
        told.alias("app_reportes"),
        as_int(report, "dif_tmin"),
        as_int(report, "dif_tmax"),
        as_int(report, "tmin").alias("t_min"),
        as_int(report, "tmax").alias("t_max"),
    )
    if mode == "predict":
        return report.filter((F.col("saison") == annee) & (F.col("sem") == semaine))
    return report.orderBy("saison", "sem")


def weekly_intake(deliveries: DataFrame) -> DataFrame:
    """Delivered quantity per week."""
    return _weekly_sum(deliveries, "date_recolte", "quantite_recolte", "quantite_recolte", None)


def _weather_weeks(
    forecast: DataFrame, deliveries: DataFrame, weather: DataFrame, *, site: int
) -> DataFrame:
    """Weather weeks with forecast, actual intake and delivery count."""
    actual = deliveries.groupBy(*_week_of("date_recolte")).agg(
        F.sum("quantite_recolte").alias("reel"), F.count("code_adherent").alias("nbr_apports")
    )
    predicted = _weekly_sum(forecast, "jour", "dt", "rf", None)
    return weekly_weather(weather, site=site).join(actual, WEEK, "left").join(predicted, WEEK, "left")


def forecast_stat(
    forecast: DataFrame,
    deliveries: DataFrame,
    final: DataFrame,
    counts: DataFrame,
    weather: DataFrame,
    *,
    site: int,
) -> DataFrame:
    """First and final weekly forecast against actual intake, with weather changes.

    Changes are taken over all weather weeks, before weeks without a final forecast are
    dropped.
    """
    order = Window.orderBy(*WEEK)
    weeks = _weather_weeks(forecast, deliveries, weather, site=site).withColumns(
        {f"diff_{m}": F.col(m) - F.lag(m).over(order) for m in ("tmin", "tmax")}
    )
    known = final.filter(F.col("pred").isNotNull()).select(*WEEK, F.col("pred").alias("pred_iter2"))
    return (
        weeks.join(known, WEEK)
        .join(counts, WEEK, "left")
        .select(
            *WEEK,
            F.col("rf").alias("pred_iter1"),
            "pred_iter2",
            F.col("reel").alias("quantite_recolte"),
            percent_error(F.col("rf"), F.col("reel")).alias("erreur_pct_iter1"),
            percent_error(F.col("pred_iter2"), F.col("reel")).alias("erreur_pct_iter2"),
            "tmin",
            "diff_tmin",
            "tmax",
            "diff_tmax",
            "rr10",
            "apports_reportes",
            "apports_predits",
            (F.col("apports_predits") - F.col("apports_reportes")).alias("diff_apports"),
        )
        .orderBy(*WEEK)
    )


def frost_weighted_forecast(
    forecast: DataFrame, deliveries: DataFrame, weather: DataFrame, *, site: int
) -> DataFrame:
    """Weekly forecast damped in cold weeks, and the change in delivery counts.

    Fixed values: a week colder than 10 is divided by 2 (previous below 30) or by 1.5
    (previous below 50), a week colder than 25 by 1.4. "Previous" follows (week, year)
    order and counts as warm where there is none.
    """
    weeks = _weather_weeks(forecast, deliveries, weather, site=site)
    floating = isinstance(weeks.schema["rf"].dataType, (DoubleType, FloatType))

    def divided(divisor: float) -> Column:
        value = F.col("rf") / F.lit(divisor)
        return (F.rint(value) if floating else F.round(value, 0)).cast("bigint")

    by_week = Window.orderBy("semaine", "annee")
    # weeks without deliveries come last in the count order
    counted = F.col("nbr_apports").isNull()
    by_count = Window.orderBy(counted, *WEEK)
    previous = F.lag("tmin").over(by_week)
    last_count = F.lag("nbr_apports").over(by_count)
    tmin = F.col("tmin")
    return weeks.select(
        *WEEK,
        as_long(weeks, "rf"),
        "tmin",
        F.when((tmin < 10) & (previous < 30), divided(2.0))
        .when((tmin < 10) & (previous < 50), divided(1.5))
        .when(tmin < 25, divided(1.4))
        .otherwise(as_long(weeks, "rf"))
        .alias("pond"),
        "nbr_apports",
        (F.col("nbr_apports") - last_count).alias("diff_apports"),
        last_count.alias("apports_semaine_derniere"),
    )
