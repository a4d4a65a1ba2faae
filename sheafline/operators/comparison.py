"""Comparison of forecasts: models side by side, error metrics, rank correlation."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from sheafline.functions import as_long, calendar_year, iso_week, ratio
from sheafline.functions.dates import as_date

# fixed values: the two site columns each model's forecast is the sum of
MODEL_COLUMNS = {
    "blend": ("bro_pred_vg", "bro_pred_cleder"),
    "knn": ("pred_vg_fd_knn", "pred_cleder_fd_knn"),
    "xgb": ("pred_vg_fd_xgb", "pred_cleder_fd_xgb"),
    "keras": ("pred_vg_fd_keras", "pred_cleder_fd_keras"),
}
COMPARED_WEEKS = 3
#: Ranges of values that are ranked apart.
RANGES = 64


def _first_weeks(df: DataFrame, day: str, as_of: dt.date, sums: dict[str, Column]) -> DataFrame:
    """Weekly sums from the week before ``as_of`` on, within its year; three weeks."""
    year = as_of.year
    within = F.col(day).between(F.lit(dt.date(year, 1, 1)), F.lit(dt.date(year, 12, 31)))
    week = iso_week(F.col(day))
    return (
        # the year as a range of days can reach the scan
        df.filter(within & (week >= as_of.isocalendar().week - 1))
        .groupBy(week.alias("sem"), calendar_year(F.col(day)).alias("an"))
        .agg(*(F.sum(value).alias(name) for name, value in sums.items()))
        .orderBy("sem", "an")
        .limit(COMPARED_WEEKS)
    )


def model_comparison_weekly(
    forecasts: DataFrame, deliveries: DataFrame, *, as_of: dt.date | str
) -> DataFrame:
    """Weekly forecast of four models beside the actual intake, in week order.

    The models share their weeks, so one aggregation serves all four.
    """
    day = as_date(as_of)
    models = {name: F.col(a) + F.col(b) for name, (a, b) in MODEL_COLUMNS.items()}
    predicted = _first_weeks(forecasts, "jour", day, models)
    actual = _first_weeks(deliveries, "liv_date", day, {"qte_reelle": F.col("liv_qty")})
    weeks = predicted.drop("an").join(actual.drop("an"), "sem", "left")
    return weeks.select(
        *(as_long(weeks, name) for name in (*MODEL_COLUMNS, "qte_reelle")), "sem"
    ).orderBy("sem")


def forecast_metrics(
    df: DataFrame, *, predicted: str, actual: str, keys: Sequence[str] = ()
) -> DataFrame:
    """RMSE, MAE, MAPE and signed MPE in percent over rows where both values are known."""
    p, a = F.col(predicted).cast("double"), F.col(actual).cast("double")
    error = p - a
    return (
        df.filter(p.isNotNull() & a.isNotNull())
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sqrt(F.avg(error * error)).alias("rmse"),
            F.avg(F.abs(error)).alias("mae"),
            F.avg(ratio(F.abs(error), F.abs(a)) * 100).alias("mape"),
            F.avg(ratio(a - p, a) * 100).alias("mpe"),
        )
    )


def average_ranks(df: DataFrame, column: str, *, keys: Sequence[str], ranges: int = RANGES) -> DataFrame:
    """Distinct values of ``column`` per key with their ``rank`` among all rows; ties share the average rank.

    Rows are reduced to counts of values. About equal ranges of values are cut at approximate
    percentiles; a value's rank is the count of the ranges before its own, and of the lower values
    in its own. So a key with most of the rows is ranked by many tasks, and the cuts decide only
    about their sizes, not about ranks. NULL has no rank.
    """
    counts = df.filter(F.col(column).isNotNull()).groupBy(*keys, column).agg(F.count(F.lit(1)).alias("n"))
    shares = F.array(*(F.lit(k / ranges) for k in range(1, max(ranges, 2))))
    cuts = counts.groupBy(*keys).agg(F.percentile_approx(column, shares, 10 * ranges).alias("cuts"))
    within_range = F.size(F.filter("cuts", lambda cut: cut <= F.col(column)))
    placed = counts.join(cuts, list(keys)).withColumn("range", within_range).drop("cuts")
    # a row per range
    earlier = Window.partitionBy(*keys).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy(*keys, "range").agg(F.sum("n").alias("total"))
    offsets = totals.select(*keys, "range", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("offset"))
    lower = Window.partitionBy(*keys, "range").orderBy(column).rowsBetween(Window.unboundedPreceding, -1)
    counted = placed.withColumn("lower", F.coalesce(F.sum("n").over(lower), F.lit(0)))
    rank = F.col("offset") + F.col("lower") + (F.col("n") + 1) / 2
    return counted.join(offsets, [*keys, "range"]).select(*keys, column, rank.alias("rank"))


def rank_correlation(
    df: DataFrame, *, features: Sequence[str], target: str, keys: Sequence[str], ranges: int = RANGES
) -> DataFrame:
    """Spearman correlation of each feature with the target, per key.

    Ranks run over the rows where both values are known; ties share their average rank. The
    input is read once for the rows and once for the ranks of each side; pass a staged one.
    """
    pairs = (
        df.unpivot(
            [*keys, target],
            [F.col(f).cast("double").alias(f) for f in features],
            "feature",
            "value",
        )
        .filter(F.col("value").isNotNull() & F.col(target).isNotNull())
        .select(*keys, "feature", "value", F.col(target).cast("double").alias("target"))
    )
    group = [*keys, "feature"]
    ranked = pairs
    for side in ("value", "target"):
        ranks = average_ranks(pairs.select(*group, side), side, keys=group, ranges=ranges)
        ranked = ranked.join(ranks.withColumnRenamed("rank", f"rank_{side}"), [*group, side])
    return ranked.groupBy(*group).agg(F.count(F.lit(1)).alias("n"), F.corr("rank_value", "rank_target").alias("rho"))
