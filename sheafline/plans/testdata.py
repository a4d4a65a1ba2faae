"""The source tables, derived from the TPC-H-like test data.

Deliveries come from line items, plantings, weather and forecasts from orders, growers
from suppliers. Dates move by a fixed number of days onto 2016-2022. The derived date is
an expression over the stored timestamp, which no optimizer can invert, so the readers
take ``since``/``until`` bounds and state them on the stored column, where the parquet
scan can use them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sheafline.functions.dates import as_date
from sheafline.operators.quality import sentinel_to_null
from sheafline.sources.tables import PLANTING_YEARS

# fixed value: days between the stored dates and the derived ones
DAY_SHIFT = 7670

ARCHIVE_END = dt.date(2018, 1, 1)
PREDICTION_START = dt.date(2021, 1, 1)

_Bound = dt.date | str | None


class TestTables:
    """Derived source tables of one test data directory."""

    __test__ = False

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self._dir = sf_dir
        self._frames: dict[str, DataFrame] = {}

    def _read(self, name: str) -> DataFrame:
        # the schema is looked up in the file once per table
        if name not in self._frames:
            self._frames[name] = self.spark.read.parquet(f"{self._dir}/{name}.parquet")
        return self._frames[name]

    @staticmethod
    def _day(stored: str) -> Column:
        return F.date_add(F.to_date(stored), DAY_SHIFT)

    @staticmethod
    def _bounded(df: DataFrame, stored: str, since: _Bound, until: _Bound) -> DataFrame:
        """Rows whose derived day is in [since, until), filtered on the stored column."""
        kind = df.schema[stored].dataType

        def moment(day: dt.date | str) -> Column:
            at = as_date(day) - dt.timedelta(days=DAY_SHIFT)
            return F.lit(at.isoformat()).cast(kind)

        if since is not None:
            df = df.filter(F.col(stored) >= moment(since))
        if until is not None:
            df = df.filter(F.col(stored) < moment(until))
        return df

    def _line_items(self, since: _Bound, until: _Bound) -> DataFrame:
        return self._bounded(self._read("lineitem"), "l_shipdate", since, until)

    def _orders(self, since: _Bound = None, until: _Bound = None) -> DataFrame:
        return self._bounded(self._read("orders"), "o_orderdate", since, until)

    # deliveries

    def deliveries_all(self, since: _Bound = None, until: _Bound = None) -> DataFrame:
        return self._line_items(since, until).select(
            self._day("l_shipdate").alias("date_recolte"),
            F.col("l_suppkey").alias("code_adherent"),
            F.col("l_quantity").cast("bigint").alias("quantite_recolte"),
        )

    def deliveries_archive(self) -> DataFrame:
        return self.deliveries_all(until=ARCHIVE_END)

    def deliveries(self, since: _Bound = None, until: _Bound = None) -> DataFrame:
        return self.deliveries_all(since=max(as_date(since or ARCHIVE_END), ARCHIVE_END), until=until)

    def deliveries_pred(self, since: _Bound = None, until: _Bound = None) -> DataFrame:
        return self.deliveries_all(
            since=max(as_date(since or PREDICTION_START), PREDICTION_START), until=until
        )

    def grower_deliveries(self, since: _Bound = None, until: _Bound = None) -> DataFrame:
        return self._line_items(since, until).select(
            F.col("l_suppkey").alias("prdcode"),
            self._day("l_shipdate").alias("liv_date"),
            F.col("l_quantity").cast("bigint").alias("liv_qty"),
        )

    def grower_deliveries_pred(self) -> DataFrame:
        """Deliveries announced for the prediction set; a table of its own."""
        return self._read("orders").select(
            (F.col("o_custkey") % 100).alias("prdcode"),
            self._day("o_orderdate").alias("liv_date"),
            (F.col("o_orderkey") % 60 + 1).cast("bigint").alias("liv_qty"),
        )

    # calendar

    def calendar_all(self) -> DataFrame:
        shipped = self._read("lineitem").select(self._day("l_shipdate").alias("jour"))
        ordered = self._read("orders").select(self._day("o_orderdate").alias("jour"))
        return shipped.union(ordered).distinct()

    def calendar(self) -> DataFrame:
        return self.calendar_all().filter(F.dayofweek("jour") > 1)

    def holidays(self) -> DataFrame:
        day = F.month("jour") * 100 + F.dayofmonth("jour")
        return (
            self._read("orders")
            .select(self._day("o_orderdate").alias("jour"))
            .filter(day.isin(101, 501, 508, 714, 815, 1101, 1111, 1225))
            .distinct()
        )

    # weather

    def weather_raw(self) -> DataFrame:
        """One row per (day, site); -99 stands for a missing measure."""
        base = (
            self._read("orders")
            .groupBy(
                self._day("o_orderdate").alias("date_reelle"),
                (F.col("o_custkey") % 4).alias("code_insee"),
            )
            .agg(F.sum("o_orderkey").alias("k"), F.sum("o_custkey").alias("u"))
        )
        k, u = F.col("k"), F.col("u")

        def measure(residue: int, modulus: int) -> Column:
            return F.when(k % 13 == residue, F.lit(-99)).otherwise(u % modulus)

        return base.select(
            "date_reelle",
            "code_insee",
            (k % 36 - 5 - u % 9).alias("tmin"),
            (k % 36 - 2).alias("tmax"),
            F.when(u % 17 == 0, F.lit(-99))
            .otherwise(F.greatest(u % 29 - 9, F.lit(0)))
            .cast("bigint")
            .alias("rr10"),
            measure(0, 8).alias("etp"),
            measure(1, 50).alias("probawind70"),
            measure(2, 40).alias("probawind100"),
            measure(3, 60).alias("probafrost"),
            measure(4, 70).alias("probafog"),
            measure(5, 90).alias("probarain"),
            measure(6, 110).alias("gust10m"),
            measure(7, 55).alias("wind10m"),
            measure(8, 15).alias("sunhours"),
        )

    def weather(self) -> DataFrame:
        return sentinel_to_null(self.weather_raw())

    # plantings and sowings

    def plantings(self) -> DataFrame:
        year = F.year("date_plantation")
        surface = F.when(F.col("o_custkey") % 3 != 0, (F.col("o_custkey") % 5) * F.lit(0.5))
        orders = self._read("orders").withColumn("date_plantation", self._day("o_orderdate"))
        return orders.select(
            (F.col("o_custkey") % 100).alias("code_adherent"),
            F.col("o_orderpriority").alias("variete_norm"),
            "date_plantation",
            # the second year fills a wrong-year column on purpose
            *(
                F.when(year.isin(column_year, column_year - 1), surface).alias(f"surface_{column_year}")
                for column_year in PLANTING_YEARS
            ),
        )

    def sowings(self) -> DataFrame:
        return (
            self._read("orders")
            .filter(F.col("o_custkey") % 100 != 13)
            .groupBy(
                (F.col("o_custkey") % 100).alias("code_adherent"),
                F.year(self._day("o_orderdate")).alias("annee"),
            )
            .agg(F.sum(F.col("o_custkey") % 50).alias("quantite_initiale"))
        )

    def growers(self) -> DataFrame:
        nation = F.col("s_nationkey").cast("bigint")
        return (
            self._read("supplier")
            .filter(F.col("s_suppkey") % 20 != 7)
            .select(
                F.col("s_suppkey").alias("code_adherent"),
                (nation % 4).alias("code_insee"),
                F.when(nation % 5 != 4, nation % 7).alias("numero_station"),
            )
        )

    # forecasts

    def forecast_daily(self, since: _Bound = None, until: _Bound = None) -> DataFrame:
        return (
            self._orders(since, until)
            .groupBy(self._day("o_orderdate").alias("jour"))
            .agg((F.sum("o_orderkey") % 900 + 200).cast("bigint").alias("dt"))
        )

    def delivery_counts(self) -> DataFrame:
        day = self._day("l_shipdate")
        key_sum = F.sum("l_suppkey")
        return (
            self._read("lineitem")
            .groupBy(F.weekofyear(day).alias("semaine"), F.year(day).alias("annee"))
            .agg(
                F.count(F.lit(1)).alias("apports_reportes"),
                F.when(key_sum % 9 != 0, F.count(F.lit(1)) + key_sum % 5 + 1).alias("apports_predits"),
            )
        )

    def forecast_final(self) -> DataFrame:
        day = self._day("o_orderdate")
        return (
            self._read("orders")
            .groupBy(F.year(day).alias("annee"), F.weekofyear(day).alias("semaine"))
            .agg(F.sum("o_custkey").alias("total"))
            .filter(F.col("total") % 4 != 0)
            .select("annee", "semaine", (F.col("total") % 4000 + 500).alias("pred"))
        )

    def model_forecasts(self, since: _Bound = None, until: _Bound = None) -> DataFrame:
        base = (
            self._orders(since, until)
            .groupBy(self._day("o_orderdate").alias("jour"))
            .agg(F.sum("o_orderkey").alias("k"), F.sum("o_custkey").alias("u"))
        )
        k, u = F.col("k"), F.col("u")
        return base.select(
            "jour",
            (k % 101).alias("bro_pred_vg"),
            (u % 103).alias("bro_pred_cleder"),
            (k % 107).alias("pred_vg_fd_knn"),
            (u % 109).alias("pred_cleder_fd_knn"),
            (k % 113).alias("pred_vg_fd_xgb"),
            F.when(u % 11 != 0, u % 127).alias("pred_cleder_fd_xgb"),
            (k % 131).alias("pred_vg_fd_keras"),
            (u % 137).alias("pred_cleder_fd_keras"),
        )

    def duplicated_weather(self) -> DataFrame:
        """Weather with its very wet rows repeated, for the duplicate check."""
        copies = F.when(F.col("rr10") > 15, F.lit(2)).otherwise(F.lit(1))
        return self.weather().withColumn("copy", F.explode(F.sequence(F.lit(1), copies))).drop("copy")
