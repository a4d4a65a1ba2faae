"""Season features: plantings, deliveries and weather per harvest day.

Deliveries are reduced to one row per (day, season, grower) in one pass over the fact
table. Everything after that is bounded by the calendar times the growers, or by the
calendar alone.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from sheafline.functions import (
    as_int,
    as_long,
    calendar_year,
    date_literal,
    harvest_season,
    iso_week,
    planting_season,
    ratio,
    season_day,
    sunday_weekday,
)
from sheafline.functions.dates import as_date
from sheafline.functions.seasons import (
    FIRST_SEASON,
    FIRST_SEASON_END,
    LAST_HARVEST_SEASON,
    LAST_PLANTING_SEASON,
    LAST_WEEKLY_SEASON,
)
from sheafline.operators.weather import weather_cumuls, weather_day_flags
from sheafline.sources.tables import PLANTING_YEARS

# fixed values: plants per unit of surface, and harvests counted per plant
PLANTS_PER_SURFACE = 12000
HARVESTS_PER_PLANT = 3

# fixed values: first day of the feature table, first day of the backtest
FEATURES_START = dt.date(2016, 3, 4)
BACKTEST_START = dt.date(2016, 1, 1)

# fixed value: weekday (Sunday = 0) of the run, the last one known in a running week
LAST_KNOWN_WEEKDAY = 4

# fixed values: trailing sums in the feature table, as (sum, output name)
DOUBLE_CUMULS = (
    ("cumultmax7", "cumul_tmax7"), ("cumultmax38", "cumul_tmax38"), ("cumultmax60", "cumul_tmax60"),
    ("cumultmin8", "cumul_tmin8"), ("cumultmin35", "cumul_tmin35"), ("cumultmin60", "cumul_tmin60"),
    ("cumuljourfroid7", "cumul_jourfroid7"), ("cumuljourfroid35", "cumul_jourfroid35"),
    ("cumuljourfroid60", "cumul_jourfroid60"),
    ("cumuljourchaud8", "cumul_jourchaud8"), ("cumuljourchaud38", "cumul_jourchaud38"),
    ("cumuljourchaud60", "cumul_jourchaud60"),
    ("cumulrr107", "cumul_pluie7"), ("cumulrr1037", "cumul_pluie37"), ("cumulrr1060", "cumul_pluie60"),
    ("cumuljourdoux9", "cumul_jourdoux9"), ("cumuljourdoux38", "cumul_jourdoux38"),
    ("cumuljourdoux60", "cumul_jourdoux60"),
    ("cumularrosage7", "cumul_jour_de_pluie7"), ("cumularrosage37", "cumul_jour_de_pluie37"),
    ("cumularrosage60", "cumul_jour_de_pluie60"),
)
INT_CUMULS = (
    ("cumulgel7", "gel7"), ("cumulgel38", "gel38"), ("cumulgel60", "gel60"),
    ("cumuljtf7", "jtf7"), ("cumuljtf38", "jtf38"), ("cumuljtf60", "jtf60"),
    ("cumulpm7", "pm7"), ("cumulpm38", "pm38"), ("cumulpm60", "pm60"),
    ("cumulpf7", "pf7"), ("cumulpf38", "pf38"), ("cumulpf60", "pf60"),
    ("cumulfroid7", "fr7"), ("cumulfroid38", "fr38"), ("cumulfroid60", "df60"),
)


#: Columns of a table of seasons, and where the open first season begins in it.
INTERVALS = "saison int, premier date, dernier date, rang int"
INTERVALS_START = dt.date(2000, 1, 1)

WEEKLY_LAGS = tuple(f"{name}_{k}" for name in ("mi_recolte", "ratio") for k in range(1, 6))


def sowing_unpivot(
    plantings: DataFrame, *, years: Iterable[int] = PLANTING_YEARS, text_grower: bool = True
) -> DataFrame:
    """One row per planting whose surface column matches its planting year.

    A planting keeps the surface of its own year only, so the wide columns are picked
    from by year: one row in, at most one row out, where a general unpivot would first
    make a row per year. ``text_grower`` gives the grower as text; plans that go on to
    join on it leave it as it is.
    """
    grower = F.col("code_adherent")
    year = F.year("date_plantation")
    surface = F.coalesce(*(F.when(year == y, F.col(f"surface_{y}")) for y in years))
    return (
        plantings.withColumn("surface", surface)
        .filter(F.col("surface").isNotNull())
        .select(
            (grower.cast("string") if text_grower else grower).alias("code_adherent"),
            "variete_norm",
            "date_plantation",
            (F.col("surface") * PLANTS_PER_SURFACE).alias("qte_semis"),
            year.alias("annee"),
        )
    )


def harvest_intervals(spark: SparkSession, *, since: dt.date = INTERVALS_START) -> DataFrame:
    """The harvest seasons that ``functions.seasons`` knows, as intervals; the first one from ``since`` on."""
    rows = [(FIRST_SEASON, since, FIRST_SEASON_END - dt.timedelta(days=1), 0)]
    for first in range(FIRST_SEASON + 1, LAST_HARVEST_SEASON + 1):
        rows.append((first, dt.date(first, 9, 1), dt.date(first + 1, 8, 31), 1))
    return spark.createDataFrame(rows, INTERVALS)


def planting_intervals(spark: SparkSession, *, since: dt.date = INTERVALS_START) -> DataFrame:
    """The planting seasons as intervals. They overlap the first one, which wins by its rank."""
    rows = [(FIRST_SEASON, since, FIRST_SEASON_END - dt.timedelta(days=1), 0)]
    for last in range(FIRST_SEASON + 1, LAST_PLANTING_SEASON + 1):
        rows.append((last, dt.date(last - 1, 5, 15), dt.date(last, 5, 14), 1))
    return spark.createDataFrame(rows, INTERVALS)


def season_of_days(seasons: DataFrame) -> DataFrame:
    """Intervals (saison, premier, dernier, rang) as a row per day: (jour, saison).

    Of several seasons that hold a day, that of the lowest rank is taken, then the lowest season.
    An interval that ends before it begins holds no day.
    """
    days = seasons.filter(F.col("premier") <= F.col("dernier")).select(
        "saison", "rang", F.explode(F.sequence("premier", "dernier")).alias("jour")
    )
    first = F.min(F.struct("rang", "saison")).alias("first")
    return days.groupBy("jour").agg(first).select("jour", F.col("first.saison").cast("int").alias("saison"))


def _with_season(df: DataFrame, day: str, seasons: DataFrame) -> DataFrame:
    """``df`` with the season of its day, NULL for a day in no interval; a new season is a new row."""
    return df.join(season_of_days(seasons).withColumnRenamed("jour", day), day, "left")


def with_planting_season(sowing: DataFrame, *, seasons: DataFrame | None = None) -> DataFrame:
    """Plantings with their planting season, by the known rule or by a table of intervals."""
    if seasons is not None:
        return _with_season(sowing, "date_plantation", seasons).select(*sowing.columns, "saison")
    return sowing.withColumn("saison", planting_season(F.col("date_plantation")))


def sowing_season(sowing: DataFrame) -> DataFrame:
    """Planted quantity per grower and planting season."""
    return sowing.groupBy("code_adherent", "saison").agg(F.sum("qte_semis").alias("qte_semis"))


def sowing_season_totals(sowing: DataFrame) -> DataFrame:
    """Expected harvests per planting season."""
    totals = sowing.groupBy("saison").agg(F.sum(F.col("qte_semis") * HARVESTS_PER_PLANT).alias("qte_semis"))
    return totals.select("saison", as_long(totals, "qte_semis"))


def harvest_season_by_grower(deliveries: DataFrame, *, seasons: DataFrame | None = None) -> DataFrame:
    """Delivered quantity per day, harvest season and grower.

    The season follows from the day, so it is no grouping key: by the known rule, or by a table of
    intervals, which meets the reduced rows by day.
    """
    daily = deliveries.groupBy("date_recolte", "code_adherent").agg(
        F.sum("quantite_recolte").alias("quantite_recolte")
    )
    if seasons is not None:
        dated = _with_season(daily, "date_recolte", seasons)
        return dated.select("date_recolte", "saison", "code_adherent", "quantite_recolte")
    return daily.select(
        "date_recolte",
        harvest_season(F.col("date_recolte")).alias("saison"),
        "code_adherent",
        "quantite_recolte",
    )


def intake_with_sowing(harvest: DataFrame, sowing: DataFrame) -> DataFrame:
    """Intake per day beside the season's planting of the growers who delivered.

    A grower's planting counts again on each of the grower's days. Both sides of the
    join are aggregated, so a grower has at most one row per day. Growers are compared
    as text only if the two sides differ in type.
    """
    grower = "code_adherent"
    if harvest.schema[grower].dataType != sowing.schema[grower].dataType:
        harvest = harvest.withColumn(grower, F.col(grower).cast("string"))
        sowing = sowing.withColumn(grower, F.col(grower).cast("string"))
    return (
        harvest.join(sowing, ["saison", grower], "left")
        .groupBy("date_recolte")
        .agg(F.sum("qte_semis").alias("qte_semis"), F.sum("quantite_recolte").alias("quantite_recolte"))
    )


def _weekly_keys() -> list[Column]:
    day = F.col("date_recolte")
    return [calendar_year(day).alias("annee"), iso_week(day).alias("semaine")]


def _weekly_season() -> Column:
    return harvest_season(F.col("date_recolte"), last=LAST_WEEKLY_SEASON, open_ended=True)


def midweek_ratio_lags(daily: DataFrame) -> DataFrame:
    """Share of each week's intake received by Thursday, with its five predecessors.

    ``daily`` has one row per day. The whole week's total is taken from the same weekly
    rows, so the input is read once. A week over 1 September has a row per season, the
    earlier season first.
    """
    day, quantity = F.col("date_recolte"), F.col("quantite_recolte")
    early = sunday_weekday(day) <= LAST_KNOWN_WEEKDAY
    parts = daily.groupBy(*_weekly_keys(), _weekly_season().alias("saison")).agg(
        F.sum(F.when(early, quantity)).alias("mi_week_quantite_recolte"),
        F.sum(quantity).alias("part"),
        F.max(early).alias("has_early"),
    )
    whole_week = Window.partitionBy("annee", "semaine")
    weeks = (
        parts.withColumn("quantite_recolte", F.sum("part").over(whole_week))
        .filter("has_early")
        .withColumn("ratio", ratio(F.col("mi_week_quantite_recolte"), F.col("quantite_recolte")))
    )
    # at most a few rows per week: bounded by the calendar, so one task may order it
    order = Window.orderBy("annee", "semaine", "saison")
    sources = {"ratio": "ratio", "mi_recolte": "mi_week_quantite_recolte"}
    lags = {
        name: F.lag(sources[name[:-2]], int(name[-1])).over(order) for name in WEEKLY_LAGS
    }
    return weeks.withColumns(lags).select(
        "semaine", "annee", "saison", "mi_week_quantite_recolte", "quantite_recolte", "ratio", *lags
    )


def remaining_plants(daily: DataFrame, totals: DataFrame) -> DataFrame:
    """Plants left to harvest at the start of each week; NULL in a season's first week."""
    weekly = daily.groupBy(_weekly_season().alias("saison"), *_weekly_keys()).agg(
        F.sum("quantite_recolte").alias("quantite_recolte")
    )
    before = (
        Window.partitionBy("saison")
        .orderBy("annee", "semaine")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return weekly.join(totals, "saison").select(
        "saison",
        "semaine",
        "annee",
        "quantite_recolte",
        "qte_semis",
        (F.col("qte_semis") - F.sum("quantite_recolte").over(before)).alias("nbre_semis_restant"),
    )


def weekly_features_to_day(daily: DataFrame, ratios: DataFrame, remaining: DataFrame) -> DataFrame:
    """Weekly features put on each harvest day.

    The days of a week with two seasons come once per pair of season rows, as the weekly
    tables are joined on week and year alone.
    """
    keyed = daily.select("date_recolte", *_weekly_keys())
    week = ["annee", "semaine"]
    early = ratios.select(
        *week, "saison", "mi_week_quantite_recolte", *WEEKLY_LAGS, F.lit(True).alias("__early")
    )
    left = remaining.select(*week, "nbre_semis_restant")
    return (
        keyed.join(early, week, "left")
        .join(left, week, "left")
        .select(
            "date_recolte",
            "saison",
            # the week of the ratio table, NULL for days it does not cover
            F.when(F.col("__early"), F.col("semaine")).alias("semaine"),
            "mi_week_quantite_recolte",
            *WEEKLY_LAGS,
            "nbre_semis_restant",
        )
    )


def season_days(intake: DataFrame, weekly: DataFrame) -> DataFrame:
    """Daily intake and planting with the weekly features' season and the season day."""
    return intake.join(weekly.select("date_recolte", "saison", "semaine"), "date_recolte", "left").select(
        "date_recolte",
        "quantite_recolte",
        "qte_semis",
        "saison",
        "semaine",
        season_day(F.col("date_recolte")).alias("jour_saison"),
    )


def repeat_by_weekly_rows(intake: DataFrame, totals: DataFrame) -> DataFrame:
    """Repeat each harvest day as often as joining the weekly features would.

    The feature table shows no weekly feature, only the row repetition their join
    causes: (seasons with early days in the week) x (seasons in the week with a planting
    total), each at least one. Counting them over the days of the week gives the same
    rows without building or joining the weekly tables.
    """
    planted = totals.select("saison", F.lit(True).alias("__planted"))
    days = intake.withColumn("saison", _weekly_season()).join(planted, "saison", "left")
    keys = dict(zip(("__annee", "__semaine"), _weekly_keys()))
    week = Window.partitionBy(*keys)
    early = sunday_weekday(F.col("date_recolte")) <= LAST_KNOWN_WEEKDAY
    copies = F.greatest(F.size(F.collect_set(F.when(early, F.col("saison"))).over(week)), F.lit(1)) * F.greatest(
        F.size(F.collect_set(F.when(F.col("__planted"), F.col("saison"))).over(week)), F.lit(1)
    )
    return (
        days.withColumns(keys)
        .withColumn("__copies", copies)
        .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
        .select(*intake.columns)
    )


def _feature_rows(
    deliveries: DataFrame,
    plantings: DataFrame,
    weather: DataFrame,
    *,
    site: int,
    first: Column,
    last: Column,
) -> DataFrame:
    """The 43 feature columns of the harvest days between two days (inclusive)."""
    sowing = with_planting_season(sowing_unpivot(plantings, text_grower=False))
    intake = intake_with_sowing(harvest_season_by_grower(deliveries), sowing_season(sowing))
    days = repeat_by_weekly_rows(intake, sowing_season_totals(sowing))
    days = days.filter(F.col("date_recolte").between(first, last))
    sums = [name for name, _ in (*DOUBLE_CUMULS, *INT_CUMULS)]
    sky = weather_cumuls(weather_day_flags(weather, site=site), names=sums).select(
        F.col("date_reelle").alias("date_recolte"), "tmin", "tmax", "rr10", *sums
    )
    rows = days.join(sky, "date_recolte", "left")
    return rows.select(
        F.col("date_recolte").alias("liv_date"),
        season_day(F.col("date_recolte")).cast("int").alias("jr_saison"),
        as_long(rows, "quantite_recolte").alias("qte_recolte"),
        as_long(rows, "qte_semis").alias("quantite_initiale"),
        F.col("tmin").cast("double").alias("t_min"),
        F.col("tmax").cast("double").alias("t_max"),
        F.col("rr10").cast("double").alias("pluie"),
        *(F.col(name).cast("double").alias(alias) for name, alias in DOUBLE_CUMULS),
        *(as_int(rows, name).alias(alias) for name, alias in INT_CUMULS),
    )


def season_features(
    deliveries: DataFrame,
    plantings: DataFrame,
    weather: DataFrame,
    *,
    site: int,
    mode: str,
    jour: dt.date | str | None = None,
) -> DataFrame:
    """Season feature table.

    Mode ``predict`` gives the days after ``jour + 2`` up to ``jour + 10``, in order; any
    other mode gives all days after the first fixed one.
    """
    if mode != "predict":
        return _feature_rows(
            _year_bounded(deliveries, FEATURES_START, None),
            plantings, weather, site=site,
            first=date_literal(FEATURES_START + dt.timedelta(days=1)), last=F.lit(dt.date.max),
        )
    day = as_date(jour)
    first, last = day + dt.timedelta(days=3), day + dt.timedelta(days=10)
    rows = _feature_rows(
        _year_bounded(deliveries, first, last),
        plantings, weather, site=site, first=F.lit(first), last=F.lit(last),
    )
    return rows.orderBy("liv_date")


def season_features_backtest(
    deliveries: DataFrame,
    plantings: DataFrame,
    weather: DataFrame,
    *,
    site: int,
    max_date: dt.date | str,
) -> DataFrame:
    """Training features as they were before ``max_date``."""
    last = as_date(max_date) - dt.timedelta(days=1)
    first = max(FEATURES_START, BACKTEST_START) + dt.timedelta(days=1)
    return _feature_rows(
        _year_bounded(deliveries, first, last),
        plantings, weather, site=site, first=F.lit(first), last=F.lit(last),
    )


def _year_bounded(deliveries: DataFrame, first: dt.date, last: dt.date | None) -> DataFrame:
    """Deliveries of the calendar years of the wanted days.

    A day's features use the deliveries of its own (year, week) only, so whole years
    around the wanted days are enough. The bound is on the day itself and reaches the
    scan.
    """
    kept = deliveries.filter(F.col("date_recolte") >= F.lit(dt.date(first.year, 1, 1)))
    if last is not None:
        kept = kept.filter(F.col("date_recolte") <= F.lit(dt.date(last.year, 12, 31)))
    return kept
