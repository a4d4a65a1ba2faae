"""Schemas of the source tables and a parquet reader that applies them.

Field names are fixed values: downstream users address the tables by them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

_DATE, _INT, _LONG, _DOUBLE, _TEXT = DateType(), IntegerType(), LongType(), DoubleType(), StringType()


def _struct(**fields: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


# fixed values: the plantings table has one surface column per year
PLANTING_YEARS = (2016, 2017, 2018, 2019, 2020, 2021, 2022)

# fixed values: weather measures in which -99 stands for "missing"
WEATHER_MEASURES = (
    "tmin", "tmax", "rr10", "etp", "probawind70", "probawind100", "probafrost",
    "probafog", "probarain", "gust10m", "wind10m", "sunhours",
)

_DELIVERIES = _struct(date_recolte=_DATE, code_adherent=_LONG, quantite_recolte=_LONG)

SCHEMAS: dict[str, StructType] = {
    "deliveries_archive": _DELIVERIES,
    "deliveries": _DELIVERIES,
    "deliveries_pred": _DELIVERIES,
    "calendar": _struct(jour=_DATE),
    "weather": _struct(date_reelle=_DATE, code_insee=_LONG, **{m: _LONG for m in WEATHER_MEASURES}),
    "holidays": _struct(jour=_DATE),
    "plantings": _struct(
        code_adherent=_LONG, variete_norm=_TEXT, date_plantation=_DATE,
        **{f"surface_{year}": _DOUBLE for year in PLANTING_YEARS},
    ),
    "forecast_daily": _struct(jour=_DATE, dt=_LONG),
    "delivery_counts": _struct(semaine=_INT, annee=_INT, apports_reportes=_LONG, apports_predits=_LONG),
    "forecast_final": _struct(annee=_INT, semaine=_INT, pred=_LONG),
    "growers": _struct(code_adherent=_LONG, code_insee=_LONG, numero_station=_LONG),
    "sowings": _struct(code_adherent=_LONG, annee=_INT, quantite_initiale=_LONG),
    "grower_deliveries": _struct(prdcode=_LONG, liv_date=_DATE, liv_qty=_LONG),
    "model_forecasts": _struct(
        jour=_DATE, bro_pred_vg=_LONG, bro_pred_cleder=_LONG, pred_vg_fd_knn=_LONG,
        pred_cleder_fd_knn=_LONG, pred_vg_fd_xgb=_LONG, pred_cleder_fd_xgb=_LONG,
        pred_vg_fd_keras=_LONG, pred_cleder_fd_keras=_LONG,
    ),
    "published_forecasts": _struct(jour=_DATE, pred2=_LONG, pred1=_LONG),
    "run_logs": _struct(timest=_LONG, ml=_TEXT, info=_TEXT, log=_TEXT, page=_TEXT),
}


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Table ``name`` stored as parquet under ``root``; the schema is not inferred."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{root}/{name}")
