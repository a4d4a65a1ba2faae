"""Station features: deliveries, sowings and weather brought to packing stations.

A grower may hold a large part of all deliveries. While the grower table is small enough
for the planner to broadcast it, deliveries are joined in place and summed up per commune
map-side. Beyond that they are first reduced to one row per (grower, day), so that the
shuffle to the growers has no hot key.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from sheafline.functions import TrailingSum, as_int, as_long, date_literal, trailing_sums

# fixed values: bounds of the short training set, of its weather and of the prediction set
RECENT_DELIVERIES = dt.date(2019, 1, 1)
RECENT_SOWING_YEAR = 2019
RECENT_WEATHER = dt.date(2019, 1, 1)
PREDICTION_DELIVERIES = dt.date(2022, 1, 1)
FULL_START = 2016

# fixed values: trailing sums, today excluded, restarted each 1 January
STATION_SUMS = (
    TrailingSum("levee_fleur", "levee_brocolis_ideale", start=11),
    TrailingSum("tmax", "tmax_30j_sum", start=31),
    TrailingSum("tmax", "tmax_10j_sum", start=11),
    TrailingSum("tmax", "tmax_2j_sum", start=3),
    TrailingSum("rr10", "rr_17j_sum", start=19),
    TrailingSum("jour_froid", "jour_froid_sum", start=20),
)

AVERAGED = (
    "tmax_30j_sum", "tmax_10j_sum", "tmax_2j_sum", "tmax", "rr10", "rr_17j_sum",
    "levee_brocolis_ideale", "jour_froid_sum",
)


def select_grower_deliveries(
    deliveries: DataFrame, deliveries_pred: DataFrame, *, mode: str, start: int
) -> DataFrame:
    """The delivery rows of a mode: full or recent training set, or prediction set."""
    if mode != "train":
        return deliveries_pred.filter(F.col("liv_date") > F.lit(PREDICTION_DELIVERIES))
    if start == FULL_START:
        return deliveries
    return deliveries.filter(F.col("liv_date") >= F.lit(RECENT_DELIVERIES))


def bro_grower_intake(deliveries: DataFrame, growers: DataFrame) -> DataFrame:
    """Deliveries with their year and the grower's commune, NULL for unknown growers."""
    communes = growers.select(F.col("code_adherent").alias("prdcode"), "code_insee")
    return deliveries.join(communes, "prdcode", "left").select(
        F.col("prdcode").alias("code_adherent"),
        F.col("liv_qty").alias("quantite_recolte"),
        F.col("liv_date").alias("date_recolte"),
        F.year("liv_date").alias("annee"),
        "code_insee",
    )


def bro_weather_windows(weather: DataFrame, *, since: dt.date | str | None = None) -> DataFrame:
    """Trailing weather sums per commune and calendar year."""
    if since is not None:
        weather = weather.filter(F.col("date_reelle") > date_literal(since))
    tmax = F.col("tmax")
    base = weather.select(
        "date_reelle",
        "code_insee",
        "tmin",
        "tmax",
        "rr10",
        F.year("date_reelle").alias("__year"),
        F.when(F.col("tmin") < 5, F.lit(1)).otherwise(F.lit(0)).alias("jour_froid"),
        F.when(tmax.between(15, 25), F.lit(1)).otherwise(F.lit(0)).alias("levee_fleur"),
    )
    summed = trailing_sums(base, ["__year", "code_insee"], "date_reelle", STATION_SUMS)
    return summed.drop("__year", "jour_froid", "levee_fleur")


def bro_sowing_by_commune(
    sowings: DataFrame, growers: DataFrame, *, since_year: int | None = None
) -> DataFrame:
    """Sown quantity per commune and year."""
    if since_year is not None:
        sowings = sowings.filter(F.col("annee") >= since_year)
    per_grower = sowings.groupBy("code_adherent", "annee").agg(
        F.sum("quantite_initiale").alias("quantite_initiale")
    )
    communes = growers.select("code_adherent", "code_insee")
    return (
        per_grower.join(communes, "code_adherent", "left")
        .groupBy("code_insee", "annee")
        .agg(F.sum("quantite_initiale").alias("quantite_initiale"))
    )


def bro_intake_sowing(intake: DataFrame, sowing: DataFrame) -> DataFrame:
    """Intake per commune and day beside the commune's sowing of the year."""
    return (
        intake.groupBy("code_insee", "date_recolte", "annee")
        .agg(F.sum("quantite_recolte").alias("quantite_recolte"))
        .join(sowing, ["code_insee", "annee"], "left")
        .select("code_insee", "date_recolte", "quantite_recolte", "annee", "quantite_initiale")
    )


def bro_weather_join(intake: DataFrame, windows: DataFrame, *, unique: bool = False) -> DataFrame:
    """Distinct intake rows with the weather of the commune and day.

    ``unique`` states that the rows are distinct already and saves the shuffle.
    """
    rows = intake if unique else intake.distinct()
    sky = windows.withColumnRenamed("date_reelle", "date_recolte")
    return rows.join(sky, ["code_insee", "date_recolte"], "left")


def bro_station_lookup(rows: DataFrame, growers: DataFrame) -> DataFrame:
    """Rows repeated for each station of their commune."""
    stations = (
        growers.filter(F.col("numero_station").isNotNull())
        .select("code_insee", "numero_station")
        .distinct()
    )
    return rows.join(stations, "code_insee", "left")


def bro_station_features(
    deliveries: DataFrame,
    deliveries_pred: DataFrame,
    growers: DataFrame,
    sowings: DataFrame,
    weather: DataFrame,
    *,
    mode: str,
    start: int,
) -> DataFrame:
    """Feature table per station and day, in day order.

    Communes without a station, and deliveries of unknown growers, form the NULL
    station.
    """
    chosen = select_grower_deliveries(deliveries, deliveries_pred, mode=mode, start=start)
    # one row per grower and day meets the grower table, so no grower's deliveries gather in one task
    chosen = chosen.groupBy("prdcode", "liv_date").agg(F.sum("liv_qty").alias("liv_qty"))
    full = start == FULL_START
    sowing = bro_sowing_by_commune(sowings, growers, since_year=None if full else RECENT_SOWING_YEAR)
    windows = bro_weather_windows(weather, since=None if full else RECENT_WEATHER)
    # one sowing row per (commune, year), so the rows stay unique per (commune, day)
    intake = bro_intake_sowing(bro_grower_intake(chosen, growers), sowing)
    rows = bro_station_lookup(bro_weather_join(intake, windows, unique=True), growers)
    stations = rows.groupBy("numero_station", "date_recolte").agg(
        *(F.avg(c).alias(c) for c in AVERAGED),
        F.sum("quantite_initiale").alias("quantite_initiale"),
        F.sum("quantite_recolte").alias("quantite_recolte"),
    )
    return stations.select(
        as_int(stations, "numero_station"),
        "date_recolte",
        *AVERAGED,
        as_long(stations, "quantite_initiale"),
        as_long(stations, "quantite_recolte"),
    ).orderBy("date_recolte")
