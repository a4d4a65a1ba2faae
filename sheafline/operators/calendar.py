"""Calendar features of the daily and weekly model inputs.

All periods, phases and column orders here are fixed values of the model inputs.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from sheafline.functions import cyclic, monday_weekday

DAY_FEATURES = (
    "qte", "tmax", "tmin", "ctmin", "ctmax", "cpluie", "weekday_cos", "weekday_sin",
    "day_cos", "day_sin", "annee_cos", "annee_sin", "samedis",
)
WEEK_FEATURES = (
    "semaine", "qte", "tmin", "tmax", "pluie", "ctmax", "ctmin", "cpluie", "mois_cos",
    "mois_sin", "semaine_cos", "semaine_sin", "semaine_sin2",
)
TARGET = "qte"


class ModelInput(NamedTuple):
    features: DataFrame
    target: DataFrame
    exogenous: DataFrame


def calendar_features_day(flux: DataFrame) -> DataFrame:
    """Thirteen daily features beside the day (a date or 'YYYY-MM-DD') and other keys."""
    keys = [c for c in ("code_insee",) if c in flux.columns]
    day = F.to_date("jour")
    dom, weekday, doy = F.dayofmonth(day), monday_weekday(day), F.dayofyear(day)
    return (
        flux.withColumnsRenamed({"t_max": "tmax", "t_min": "tmin"})
        .withColumns(
            {
                "weekday_cos": cyclic("cos", weekday, 7),
                "weekday_sin": cyclic("sin", weekday + 5, 7),
                "day_cos": cyclic("cos", dom, 30.5),
                "day_sin": cyclic("sin", dom, 30.5),
                "annee_cos": cyclic("cos", doy + 315, 365.25),
                "annee_sin": cyclic("sin", doy + 265, 365.25),
                "samedis": F.when(weekday == 5, F.lit(1)).otherwise(F.lit(-1)),
            }
        )
        .select(*keys, day.alias("date_recolte"), *DAY_FEATURES)
    )


def calendar_features_week(flux: DataFrame) -> DataFrame:
    """Thirteen weekly features in week order number ``id``."""
    keys = [c for c in ("code_insee",) if c in flux.columns]
    week = F.col("semaine")
    return (
        flux.withColumnsRenamed({"sem": "semaine", "t_max": "tmax", "t_min": "tmin"})
        .withColumns(
            {
                "mois_cos": cyclic("cos", week, 12),
                "mois_sin": cyclic("sin", week, 12),
                "semaine_cos": cyclic("cos", week, 52.2),
                "semaine_sin": cyclic("sin", week, 52.2),
                "semaine_sin2": cyclic("sin", week + 4, 52.2),
            }
        )
        .select(*keys, "id", *WEEK_FEATURES)
    )


def model_input(features: DataFrame) -> ModelInput:
    """All features, the target alone, and the features without the target."""
    keys = [c for c in ("code_insee", "date_recolte", "id") if c in features.columns]
    return ModelInput(features, features.select(*keys, TARGET), features.drop(TARGET))
