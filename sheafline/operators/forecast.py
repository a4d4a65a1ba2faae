"""Forecasts of the coming six days and the coming week of each series.

The model of ``sequence_forecast`` has one ridge regression per series, kind and position: a
target day (or week) is told from its window, summarised in ``DAY_INPUTS`` (``WEEK_INPUTS``).
Its rows are reduced to moments, which add up across days, so a fit for any run date, or for
every run date of the past (``rolling_origin``), comes from sums and not from rows. Models are
a table that can be stored and picked by date. Days are compared as days throughout: what is
known at a run lies before its run day, and a lag of two weeks is the value 14 days before.

``window_regression_forecast`` is the option that fits all values of the windows over all
series at once, by ``pyspark.ml``; it runs jobs while its plan is built.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, Window, functions as F

from sheafline.functions.dates import as_date
from sheafline.operators import regression
from sheafline.operators.calendar import DAY_FEATURES, TARGET, WEEK_FEATURES
from sheafline.operators.comparison import forecast_metrics
from sheafline.operators.scaling import minmax_fit, minmax_inverse, minmax_scale
from sheafline.operators.publish import FIRST_DAY_OFFSET
from sheafline.operators.regression import REGULARISATION
from sheafline.operators.sequences import (
    DAY_FUTURE,
    DAY_GAP,
    DAY_PAST,
    WEEK_FIRST,
    WEEK_LAST,
    latest_window,
    sequence_windows_day,
    sequence_windows_week,
)
from sheafline.sources import shared

# what a target is told from: the mean of the past rows, the value two weeks before, the
# target's own weather and its place in the year
DAY_INPUTS = ("past_mean", "two_weeks", "tmax", "cpluie", "annee_cos", "annee_sin")
WEEK_INPUTS = ("past_mean", "two_weeks", "tmax", "pluie", "semaine_cos", "semaine_sin2")
INPUTS = tuple(f"x{i}" for i in range(len(DAY_INPUTS)))
TWO_WEEKS = 14

SERIES_MODEL = ("kind", "position")


def _monday(as_of: dt.date | str) -> dt.date:
    return as_date(as_of) + dt.timedelta(days=FIRST_DAY_OFFSET)


def day_rows(table: DataFrame, *, keys: Sequence[str], order: str = "date_recolte") -> DataFrame:
    """A row per target day: keys, kind, position, step, run_step, jour, is_score, label and inputs.

    Windows are counted from the end of a series, so that the last six rows are those to be
    predicted (``is_score``), at positions 0 to 5. ``step`` is the day's number, ``run_step`` that
    of the run, the row after the twelve past ones; days that no full window leads to are left
    out. The mean is that of the window's known values; it stands for the value 14 days before
    where that day has none. An input that is not known is NULL.
    """
    series = Window.partitionBy(*keys)
    ordered = series.orderBy(order)
    number = F.unix_date(F.col(order))
    at = F.row_number().over(ordered)
    past = ordered.rowsBetween(-DAY_PAST, -1)
    before = series.orderBy("step").rangeBetween(-TWO_WEEKS, -TWO_WEEKS)
    rows = table.withColumn("step", number).withColumns(
        {
            "left": F.count(F.lit(1)).over(series) - at,
            "past_known": F.avg(F.col(TARGET).cast("double")).over(past),
            "two_weeks": F.max(TARGET).over(before),
        }
    )
    rows = rows.withColumn("position", (F.lit(DAY_FUTURE - 1) - F.col("left") % DAY_FUTURE).cast("int"))

    def at_run(value: Column) -> Column:
        """The value that the window's anchor row has, ``DAY_GAP`` rows before position 0."""
        out = F.lit(None)
        for position in range(DAY_FUTURE):
            out = F.when(F.col("position") == position, F.lag(value, DAY_GAP + position).over(ordered)).otherwise(out)
        return out

    rows = rows.withColumns(
        {
            "run_step": at_run(F.col("step")),
            "past_mean": at_run(F.col("past_known")),
            "anchor": at_run(at),
        }
    ).filter(F.col("anchor") > DAY_PAST)
    rows = rows.withColumn("two_weeks", F.coalesce("two_weeks", "past_mean"))
    return _long_rows(rows, "day", keys, F.col(order), F.col("left") < DAY_FUTURE, DAY_INPUTS)


def week_rows(table: DataFrame, *, keys: Sequence[str], as_of: dt.date | str, order: str = "id") -> DataFrame:
    """A row per target week, as ``day_rows``; ``step`` is the week's number, the run is in the week before.

    The last week is to be predicted. ``jour`` is the Monday after the run if the week is that
    Monday's, else NULL; other weeks have none.
    """
    series = Window.partitionBy(*keys)
    ordered = series.orderBy(order)
    past = ordered.rowsBetween(-WEEK_FIRST, -WEEK_LAST)
    before = series.orderBy("step").rangeBetween(-WEEK_LAST, -WEEK_LAST)
    at = F.row_number().over(ordered)
    rows = table.withColumn("step", F.col(order).cast("int")).withColumns(
        {
            "left": F.count(F.lit(1)).over(series) - at,
            "anchor": at,
            "past_mean": F.avg(F.col(TARGET).cast("double")).over(past),
            "two_weeks": F.max(TARGET).over(before),
            "position": F.lit(0),
            "run_step": F.col("step") - 1,
        }
    ).filter(F.col("anchor") > WEEK_FIRST)
    rows = rows.withColumn("two_weeks", F.coalesce("two_weeks", "past_mean"))
    monday = _monday(as_of)
    coming = (F.col("left") == 0) & (F.col("semaine") == monday.isocalendar().week)
    return _long_rows(rows, "week", keys, F.when(coming, F.lit(monday)), F.col("left") == 0, WEEK_INPUTS)


def _long_rows(rows: DataFrame, kind: str, keys: Sequence[str], day: Column, is_score: Column, inputs: Sequence[str]) -> DataFrame:
    return rows.select(
        *keys,
        F.lit(kind).alias("kind"),
        "position",
        "step",
        F.col("run_step").cast("int").alias("run_step"),
        day.alias("jour"),
        is_score.alias("is_score"),
        F.col(TARGET).cast("double").alias("label"),
        *(F.col(c).cast("double").alias(x) for c, x in zip(inputs, INPUTS, strict=True)),
    )


def target_rows(day: DataFrame, week: DataFrame, *, keys: Sequence[str], as_of: dt.date | str) -> DataFrame:
    """``day_rows`` and ``week_rows`` of the calendar feature tables."""
    return day_rows(day, keys=keys).unionByName(week_rows(week, keys=keys, as_of=as_of))


def _model_keys(keys: Sequence[str]) -> list[str]:
    return [*keys, *SERIES_MODEL]


def fit_models(rows: DataFrame, *, keys: Sequence[str]) -> DataFrame:
    """Models of the coming run: keys, kind, position, trained, mean, means, coefficients.

    Trained on the targets before the run day of the rows to be predicted; a series without such
    rows has no model.
    """
    run = F.max(F.when(F.col("is_score"), F.col("run_step"))).over(Window.partitionBy(*keys, "kind"))
    known = rows.withColumn("__run", run).filter(F.col("step") < F.col("__run"))
    moments = regression.moment_rows(known, features=INPUTS, target="label")
    merged = regression.merged_moments(moments, keys=_model_keys(keys), features=INPUTS)
    return regression.solved(merged, features=INPUTS)


def predict(rows: DataFrame, models: DataFrame, *, keys: Sequence[str]) -> DataFrame:
    """Predictions of the rows marked ``is_score``: keys, kind, position, jour, pred.

    Quantities are rounded to a millionth, then cut toward zero. Without a model ``pred`` is NULL.
    """
    scored = rows.filter("is_score").join(models, _model_keys(keys), "left")
    quantity = F.round(regression.predicted(INPUTS).cast("decimal(30,6)"), 6).cast("bigint")
    return scored.select(*_model_keys(keys), "jour", quantity.alias("pred"))


def sequence_forecast(day: DataFrame, week: DataFrame, *, keys: Sequence[str], as_of: dt.date | str) -> DataFrame:
    """Daily and weekly forecast of each series: keys, kind, position, jour, pred; a lazy plan."""
    rows = target_rows(day, week, keys=keys, as_of=as_of)
    return predict(rows, fit_models(rows, keys=keys), keys=keys)


# stored models


def model_versions(rows: DataFrame, *, keys: Sequence[str], run_dates: Sequence[dt.date | str]) -> DataFrame:
    """Daily models as runs of several dates would have stored them: ``version`` beside ``fit_models``.

    Every version is trained on the target days before it. Rows are reduced to moments of the
    spans between the dates, which then add up; no row is read once a version.
    """
    dates = sorted(as_date(d) for d in run_dates)
    daily = rows.filter("kind = 'day'")
    span = F.lit(None)
    for date in reversed(dates):
        span = F.when(F.col("jour") < F.lit(date), F.lit(date)).otherwise(span)
    spans = regression.moment_rows(daily.withColumn("version", span.cast("date")), features=INPUTS, target="label")
    spans = spans.filter(F.col("version").isNotNull())
    parts = regression.merged_moments(spans, keys=[*_model_keys(keys), "version"], features=INPUTS)
    # a date without days of its own still has a version
    later = F.filter(F.array(*(F.lit(d) for d in dates)), lambda d: d >= F.col("version"))
    added = parts.withColumn("version", F.explode(later))
    merged = regression.merged_moments(added, keys=[*_model_keys(keys), "version"], features=INPUTS)
    return regression.solved(merged, features=INPUTS)


def models_as_of(stored: DataFrame, *, keys: Sequence[str], as_of: dt.date | str) -> DataFrame:
    """Of stored models the newest version up to ``as_of``, for each series and position."""
    known = stored.filter(F.col("version") <= F.lit(as_date(as_of)))
    newest = F.max_by(F.struct("version", "trained", "mean", "means", "coefficients"), "version").alias("model")
    return known.groupBy(*_model_keys(keys)).agg(newest).select(*_model_keys(keys), "model.*")


# evaluation


def rolling_origin(rows: DataFrame, *, keys: Sequence[str]) -> DataFrame:
    """Each target as a run before it would have predicted it: keys, kind, position, step, trained, label, pred.

    A run knows the targets before its run day. Running sums of moments, with the runs between
    them, give each run its own fit: one window per series and position, bounded by the calendar.
    """
    known = regression.moment_rows(rows, features=INPUTS, target="label").withColumns({"at": F.col("step"), "run": F.lit(1)})
    asked = regression.moment_rows(rows, features=INPUTS, target="label").withColumns({"at": F.col("run_step"), "run": F.lit(0)})
    for name in asked.columns:
        if name not in rows.columns and name not in ("at", "run"):
            asked = asked.withColumn(name, F.lit(None).cast(asked.schema[name].dataType))
    # a run day's own target comes after the run
    moments = regression.running_moments(
        known.unionByName(asked), keys=_model_keys(keys), order=["at", "run"], features=INPUTS
    )
    fitted = regression.solved(moments.filter("run = 0"), features=INPUTS)
    return fitted.select(
        *_model_keys(keys), "step", "trained", "label", regression.predicted(INPUTS).alias("pred")
    )


def forecast_quality(rows: DataFrame, *, keys: Sequence[str], by: Sequence[str] = SERIES_MODEL) -> DataFrame:
    """RMSE, MAE, MAPE and MPE of ``rolling_origin`` by kind and position (horizon), or by other columns."""
    return forecast_metrics(rolling_origin(rows, keys=keys), predicted="pred", actual="label", keys=by)


# regression on whole windows


def _predicted(samples: DataFrame, keys: Sequence[str], horizon: int) -> DataFrame:
    """Scaled prediction of the last sample of each series: keys, position, step, ``qte``.

    Windows with a missing value train nothing; as the sample to predict they give NULL.
    """
    flat = F.concat(
        F.flatten("past"),
        F.col("future")[F.col("position")],
        F.transform(
            F.sequence(F.lit(0), F.lit(horizon - 1)),
            lambda k: F.when(k == F.col("position"), F.lit(1.0)).otherwise(F.lit(0.0)),
        ),
    )
    rows = (
        samples.withColumn("position", F.explode(F.sequence(F.lit(0), F.lit(horizon - 1))))
        .withColumn("values", flat)
        .withColumn("complete", ~F.exists("values", lambda v: v.isNull()))
        .select(
            *keys,
            "position",
            "is_score",
            "complete",
            F.when(F.col("complete"), F.col("values")).alias("values"),
            F.col("target")[F.col("position")].alias("label"),
            F.col("days")[F.col("position")].alias("step"),
        )
    )
    train = shared(
        rows.filter(~F.col("is_score") & F.col("complete") & F.col("label").isNotNull()).select(
            array_to_vector("values").alias("features"), "label"
        )
    )
    # features share one scale already; the plain penalty keeps the system solvable where
    # a feature is constant, such as the weekday at a fixed place in six-day weeks
    regression = LinearRegression(
        featuresCol="features",
        labelCol="label",
        regParam=REGULARISATION,
        standardization=False,
        solver="normal",
    )
    # the fit passes over its input more than once: its width, its sums, its summary
    try:
        if train.isEmpty():
            raise ValueError("no complete window to train on")
        fitted = regression.fit(train)
    finally:
        train.unpersist()
    weights = F.array(*(F.lit(float(w)) for w in fitted.coefficients))
    score = F.aggregate(
        F.zip_with("values", weights, lambda v, w: v * w),
        F.lit(float(fitted.intercept)),
        lambda total, term: total + term,
    )
    return rows.filter("is_score").select(*keys, "position", "step", score.alias(TARGET))


def window_regression_forecast(
    day: DataFrame, week: DataFrame, *, keys: Sequence[str], as_of: dt.date | str
) -> DataFrame:
    """Daily and weekly forecast of each series: keys, kind, position, jour, pred.

    ``day`` and ``week`` are the calendar feature tables. Features are scaled per series
    to [-1, 1], windows cut, the last window of each series predicted and brought back
    to quantities, cut toward zero. The tables are read by the fit, for the statistics
    and for the prediction; pass staged ones. ``jour`` is as in ``target_rows``.
    """
    monday = _monday(as_of)
    coming = week.filter(F.col("semaine") == monday.isocalendar().week).select(*keys, F.col("id").alias("step"))
    plans = (
        ("day", day, "date_recolte", DAY_FEATURES, sequence_windows_day, DAY_FUTURE, {"anchored": "end"}),
        ("week", week, "id", WEEK_FEATURES, sequence_windows_week, 1, {}),
    )
    forecasts = []
    for kind, table, order, features, windows, horizon, how in plans:
        scaled = minmax_scale(table, list(features), keys=keys)
        samples = latest_window(
            windows(scaled, keys=keys, order=order, features=features, target=TARGET, **how), keys=keys
        )
        stats = minmax_fit(table, [TARGET], keys=keys)
        restored = minmax_inverse(_predicted(samples, keys, horizon), stats, [TARGET], keys=keys)
        forecasts.append(
            restored.select(*keys, F.lit(kind).alias("kind"), "position", "step", F.col(TARGET).alias("pred"))
        )
    days, weeks = forecasts
    dated = weeks.join(coming.withColumn("jour", F.lit(monday)), [*keys, "step"], "left")
    return days.withColumn("jour", F.col("step")).select(*keys, "kind", "position", "jour", "pred").unionByName(
        dated.select(*keys, "kind", "position", "jour", "pred")
    )


def weekly_series(deliveries: DataFrame, *, key: str) -> DataFrame:
    """Weekly quantity per series; a week is known by its Monday, also across the turn of a year."""
    monday = F.date_trunc("week", "date_recolte").cast("date")
    return deliveries.groupBy(key, monday.alias("lundi")).agg(F.sum("quantite_recolte").alias(TARGET))


def series_least_squares(weekly: DataFrame, *, key: str) -> DataFrame:
    """Per series: least squares of the weekly quantity on that of the Monday 14 days before.

    Two weeks, as the running week is not yet known when the next one is predicted. A week
    whose Monday 14 days before has no row is left out of the fit.
    """
    before = Window.partitionBy(key).orderBy("day").rangeBetween(-TWO_WEEKS, -TWO_WEEKS)
    pairs = weekly.withColumn("day", F.unix_date("lundi")).withColumn("known", F.max(TARGET).over(before))
    return pairs.groupBy(key).agg(
        F.count(F.when(F.col("known").isNotNull() & F.col(TARGET).isNotNull(), F.lit(1))).alias("n"),
        F.regr_slope(TARGET, "known").alias("slope"),
        F.regr_intercept(TARGET, "known").alias("intercept"),
    )
