"""One callable (spark, sf_dir) -> DataFrame per query, over whole tables.

Parameters are those of a run on Thursday 2021-06-10 for site 1. Trigonometric and
scaled values are rounded to nine places, as engines differ in the last bits.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType

from sheafline.operators import (
    calendar,
    comparison,
    forecast,
    intake,
    publish,
    quality,
    scaling,
    season,
    sequences,
    station,
    weather,
    weekly,
)
from sheafline.plans.testdata import TestTables
from sheafline.sources import staged

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = dt.date(2021, 6, 10)
SITE = 1
SITES = (0, 1, 2, 3)
YEAR, WEEK = 2021, 23
MAX_DATE = dt.date(2021, 1, 1)
SERIES = ["code_insee"]

QUERIES: dict[str, Query] = {}


def _query(build: Callable[[TestTables], DataFrame]) -> Callable[[TestTables], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(TestTables(spark, sf_dir))

    QUERIES[build.__name__] = run
    return build


def _rounded(df: DataFrame, places: int = 9, columns: Sequence[str] | None = None) -> DataFrame:
    names = columns or [f.name for f in df.schema if isinstance(f.dataType, DoubleType)]
    kind = f"decimal(30,{places})"
    return df.withColumns({c: F.col(c).cast(kind).cast("double") for c in names})


# daily and weekly intake


@_query
def deliveries_union(t: TestTables) -> DataFrame:
    return intake.deliveries_union(t.deliveries_archive(), t.deliveries())


@_query
def daily_intake(t: TestTables) -> DataFrame:
    return intake.daily_intake(intake.deliveries_union(t.deliveries_archive(), t.deliveries()))


@_query
def calendar_spine(t: TestTables) -> DataFrame:
    return intake.calendar_spine(t.calendar(), intake.daily_intake(t.deliveries_all()))


@_query
def weather_trailing(t: TestTables) -> DataFrame:
    return intake.weather_trailing(t.weather(), sites=[SITE])


@_query
def weather_trailing_all_sites(t: TestTables) -> DataFrame:
    return intake.weather_trailing(t.weather())


def _intake_tables(t: TestTables) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    return t.deliveries_archive(), t.deliveries(), t.calendar(), t.weather()


@_query
def flux_day(t: TestTables) -> DataFrame:
    return intake.flux_day(*_intake_tables(t), site=SITE)


@_query
def flux_day_sites(t: TestTables) -> DataFrame:
    return intake.flux_day_sites(*_intake_tables(t), sites=SITES)


@_query
def flux_week(t: TestTables) -> DataFrame:
    return intake.flux_week(*_intake_tables(t), site=SITE)


@_query
def flux_week_sites(t: TestTables) -> DataFrame:
    return intake.flux_week_sites(*_intake_tables(t), sites=SITES)


@_query
def flux_day_until(t: TestTables) -> DataFrame:
    return intake.flux_day_until(flux_day(t), as_of=AS_OF)


@_query
def flux_week_until_next(t: TestTables) -> DataFrame:
    weeks = intake.flux_week_sites(*_intake_tables(t), sites=[SITE])
    return intake.flux_week_until_next(weeks, as_of=AS_OF).drop("code_insee")


# weekly reports


@_query
def weekly_delivery_count(t: TestTables) -> DataFrame:
    return weekly.weekly_delivery_count(t.deliveries())


@_query
def weekly_weather(t: TestTables) -> DataFrame:
    return weekly.weekly_weather(t.weather(), site=SITE)


@_query
def weekly_worked_holidays(t: TestTables) -> DataFrame:
    return weekly.weekly_worked_holidays(t.holidays(), t.deliveries(), as_of=AS_OF)


def _profile(t: TestTables, mode: str) -> DataFrame:
    return weekly.weekly_profile(
        t.deliveries(), t.weather(), t.holidays(),
        as_of=AS_OF, site=SITE, annee=YEAR, semaine=WEEK, mode=mode,
    )


@_query
def weekly_profile(t: TestTables) -> DataFrame:
    return _profile(t, "train")


@_query
def weekly_profile_predict(t: TestTables) -> DataFrame:
    return _profile(t, "predict")


def _forecast_error(t: TestTables, mode: str) -> DataFrame:
    return weekly.weekly_forecast_error(
        t.forecast_daily(since=weekly.REPORT_START),
        t.deliveries(since=weekly.REPORT_START),
        t.delivery_counts(),
        t.weather(),
        site=SITE, mode=mode, annee=YEAR, semaine=WEEK,
    )


@_query
def weekly_forecast_error(t: TestTables) -> DataFrame:
    return _forecast_error(t, "all")


@_query
def weekly_forecast_error_predict(t: TestTables) -> DataFrame:
    return _forecast_error(t, "predict")


@_query
def forecast_stat(t: TestTables) -> DataFrame:
    return weekly.forecast_stat(
        t.forecast_daily(), t.deliveries(), t.forecast_final(), t.delivery_counts(), t.weather(), site=SITE
    )


@_query
def frost_weighted_forecast(t: TestTables) -> DataFrame:
    return weekly.frost_weighted_forecast(t.forecast_daily(), t.deliveries(), t.weather(), site=SITE)


# season features


@_query
def weather_day_flags(t: TestTables) -> DataFrame:
    return weather.weather_day_flags(t.weather())


@_query
def weather_lags(t: TestTables) -> DataFrame:
    base = t.weather().select("code_insee", "date_reelle", "tmax", "rr10")
    return weather.weather_lags(base)


@_query
def weather_cumuls(t: TestTables) -> DataFrame:
    flagged = weather.weather_day_flags(t.weather())
    names = [s.name for s in weather.cumul_sums()]
    lags = [name for name, _, _ in weather.LAGS]
    wide = weather.weather_cumuls(flagged, lags=True)
    return wide.select(
        "code_insee", "date_reelle", "tmax", "tmin", "rr10", "jourchaud", "jourdoux", "arrosage", *lags, *names
    )


@_query
def sowing_unpivot(t: TestTables) -> DataFrame:
    return season.sowing_unpivot(t.plantings())


def _sowing(t: TestTables) -> DataFrame:
    return season.with_planting_season(season.sowing_unpivot(t.plantings()))


@_query
def sowing_season(t: TestTables) -> DataFrame:
    return season.sowing_season(_sowing(t))


@_query
def sowing_season_totals(t: TestTables) -> DataFrame:
    return season.sowing_season_totals(_sowing(t))


@_query
def harvest_season_by_grower(t: TestTables) -> DataFrame:
    return season.harvest_season_by_grower(t.deliveries_all())


@_query
def harvest_season_by_grower_predict(t: TestTables) -> DataFrame:
    return season.harvest_season_by_grower(t.deliveries_pred())


@_query
def harvest_season_by_table(t: TestTables) -> DataFrame:
    """As ``harvest_season_by_grower``, with the seasons from a table."""
    return season.harvest_season_by_grower(t.deliveries_all(), seasons=season.harvest_intervals(t.spark))


@_query
def sowing_season_by_table(t: TestTables) -> DataFrame:
    """As ``sowing_season``, with the seasons from a table."""
    sowing = season.sowing_unpivot(t.plantings())
    return season.sowing_season(season.with_planting_season(sowing, seasons=season.planting_intervals(t.spark)))


@_query
def intake_with_sowing(t: TestTables) -> DataFrame:
    plantings = season.sowing_unpivot(t.plantings(), text_grower=False)
    planted = season.sowing_season(season.with_planting_season(plantings))
    return season.intake_with_sowing(harvest_season_by_grower(t), planted)


def _daily(t: TestTables) -> DataFrame:
    return intake.daily_intake(t.deliveries_all())


@_query
def midweek_ratio_lags(t: TestTables) -> DataFrame:
    return season.midweek_ratio_lags(_daily(t))


@_query
def remaining_plants(t: TestTables) -> DataFrame:
    return season.remaining_plants(_daily(t), sowing_season_totals(t))


def _weekly_to_day(daily: DataFrame, totals: DataFrame) -> DataFrame:
    return season.weekly_features_to_day(
        daily, season.midweek_ratio_lags(daily), season.remaining_plants(daily, totals)
    )


@_query
def weekly_features_to_day(t: TestTables) -> DataFrame:
    # one row per day, read by three branches
    return _weekly_to_day(staged(_daily(t)), sowing_season_totals(t))


@_query
def season_day(t: TestTables) -> DataFrame:
    # one row per day: the joined table and the weekly branches come from one scan
    days = staged(intake_with_sowing(t))
    daily = days.select("date_recolte", "quantite_recolte")
    return season.season_days(days, _weekly_to_day(daily, sowing_season_totals(t)))


@_query
def season_features(t: TestTables) -> DataFrame:
    return season.season_features(t.deliveries_all(), t.plantings(), t.weather(), site=SITE, mode="train")


@_query
def season_features_predict(t: TestTables) -> DataFrame:
    return season.season_features(
        t.deliveries_pred(), t.plantings(), t.weather(), site=SITE, mode="predict", jour=AS_OF
    )


@_query
def season_features_backtest(t: TestTables) -> DataFrame:
    return season.season_features_backtest(
        t.deliveries_all(), t.plantings(), t.weather(), site=SITE, max_date=MAX_DATE
    )


# station features


def _grower_intake(t: TestTables, mode: str, start: int) -> DataFrame:
    chosen = station.select_grower_deliveries(
        t.grower_deliveries(), t.grower_deliveries_pred(), mode=mode, start=start
    )
    return station.bro_grower_intake(chosen, t.growers())


@_query
def bro_grower_intake(t: TestTables) -> DataFrame:
    return _grower_intake(t, "train", station.FULL_START)


@_query
def bro_grower_intake_recent(t: TestTables) -> DataFrame:
    return _grower_intake(t, "train", 2019)


@_query
def bro_grower_intake_predict(t: TestTables) -> DataFrame:
    return _grower_intake(t, "predict", 2019)


@_query
def bro_weather_windows(t: TestTables) -> DataFrame:
    return station.bro_weather_windows(t.weather())


@_query
def bro_weather_windows_recent(t: TestTables) -> DataFrame:
    return station.bro_weather_windows(t.weather(), since=station.RECENT_WEATHER)


@_query
def bro_sowing_by_commune(t: TestTables) -> DataFrame:
    return station.bro_sowing_by_commune(t.sowings(), t.growers())


@_query
def bro_sowing_by_commune_recent(t: TestTables) -> DataFrame:
    return station.bro_sowing_by_commune(t.sowings(), t.growers(), since_year=station.RECENT_SOWING_YEAR)


@_query
def bro_intake_sowing(t: TestTables) -> DataFrame:
    return station.bro_intake_sowing(bro_grower_intake(t), bro_sowing_by_commune(t))


@_query
def bro_weather_join(t: TestTables) -> DataFrame:
    return station.bro_weather_join(bro_intake_sowing(t), bro_weather_windows(t))


@_query
def bro_station_lookup(t: TestTables) -> DataFrame:
    return station.bro_station_lookup(bro_weather_join(t), t.growers())


def _station_features(t: TestTables, mode: str, start: int) -> DataFrame:
    return station.bro_station_features(
        t.grower_deliveries(), t.grower_deliveries_pred(), t.growers(), t.sowings(), t.weather(),
        mode=mode, start=start,
    )


@_query
def bro_station_features(t: TestTables) -> DataFrame:
    return _station_features(t, "train", station.FULL_START)


@_query
def bro_station_features_recent(t: TestTables) -> DataFrame:
    return _station_features(t, "train", 2019)


@_query
def bro_station_features_predict(t: TestTables) -> DataFrame:
    return _station_features(t, "predict", 2019)


# data quality


@_query
def data_checks(t: TestTables) -> DataFrame:
    return quality.data_checks(t.grower_deliveries(), t.sowings(), t.growers(), t.duplicated_weather())


@_query
def sentinel_to_null(t: TestTables) -> DataFrame:
    return quality.sentinel_to_null(t.weather_raw())


# model inputs and forecasts


@_query
def model_comparison_weekly(t: TestTables) -> DataFrame:
    year = {"since": dt.date(AS_OF.year, 1, 1), "until": dt.date(AS_OF.year + 1, 1, 1)}
    return comparison.model_comparison_weekly(
        t.model_forecasts(**year), t.grower_deliveries(**year), as_of=AS_OF
    )


def _day_features(t: TestTables) -> DataFrame:
    flux = intake.flux_day_until(flux_day_sites(t), as_of=AS_OF)
    return calendar.calendar_features_day(flux)


def _week_features(t: TestTables) -> DataFrame:
    flux = intake.flux_week_until_next(flux_week_sites(t), as_of=AS_OF)
    return calendar.calendar_features_week(flux)


@_query
def calendar_features_day(t: TestTables) -> DataFrame:
    return _rounded(_day_features(t))


@_query
def calendar_features_week(t: TestTables) -> DataFrame:
    return _rounded(_week_features(t))


@_query
def minmax_scale(t: TestTables) -> DataFrame:
    scaled = scaling.minmax_scale(_day_features(t), list(calendar.DAY_FEATURES), keys=SERIES)
    return _rounded(scaled)


@_query
def minmax_scale_one_series(t: TestTables) -> DataFrame:
    # read for the bounds and for the rows
    features = staged(calendar.calendar_features_day(flux_day_until(t)))
    return _rounded(scaling.minmax_scale(features, list(calendar.DAY_FEATURES)))


@_query
def minmax_fit(t: TestTables) -> DataFrame:
    return _rounded(scaling.minmax_fit(_day_features(t), list(calendar.DAY_FEATURES), keys=SERIES))


@_query
def minmax_inverse(t: TestTables) -> DataFrame:
    columns = ["qte", "tmax", "tmin", "ctmin", "ctmax", "cpluie"]
    features = staged(_day_features(t).select(*SERIES, "date_recolte", *columns))
    stats = scaling.minmax_fit(features, columns, keys=SERIES)
    # a forecast is a scaled value between the observed ones: take half of each
    halved = scaling.minmax_scale(features, columns, keys=SERIES).withColumns(
        {c: F.col(c) / 2 for c in columns}
    )
    return scaling.minmax_inverse(halved, stats, columns, keys=SERIES)


def _day_samples(features: DataFrame, step: int, anchored: str = "start") -> DataFrame:
    return sequences.sequence_windows_day(
        features, keys=SERIES, order="date_recolte",
        features=calendar.DAY_FEATURES, target=calendar.TARGET, step=step, anchored=anchored,
    )


def _week_samples(features: DataFrame) -> DataFrame:
    return sequences.sequence_windows_week(
        features, keys=SERIES, order="id",
        features=calendar.WEEK_FEATURES, target=calendar.TARGET,
    )


@_query
def sequence_windows_day(t: TestTables) -> DataFrame:
    return _rounded(
        sequences.sequence_rows(
            _day_samples(_day_features(t), 6), keys=SERIES, features=calendar.DAY_FEATURES, target=calendar.TARGET
        )
    )


@_query
def sequence_windows_week(t: TestTables) -> DataFrame:
    return _rounded(
        sequences.sequence_rows(
            _week_samples(_week_features(t)), keys=SERIES, features=calendar.WEEK_FEATURES, target=calendar.TARGET
        )
    )


@_query
def latest_window(t: TestTables) -> DataFrame:
    def marked(kind: str, samples: DataFrame) -> DataFrame:
        latest = sequences.latest_window(samples, keys=SERIES)
        return latest.select(
            F.lit(kind).alias("kind"), *SERIES, "sample", "is_score",
            F.size("past").alias("past_rows"), F.size("future").alias("future_rows"),
            F.col("days")[0].cast("string").alias("first"), F.element_at("days", -1).cast("string").alias("last"),
        )

    day, week = _forecast_tables(t)
    return marked("day", _day_samples(day, 6, "end")).unionByName(marked("week", _week_samples(week)))


def _forecast_tables(t: TestTables) -> tuple[DataFrame, DataFrame]:
    # a row per site and calendar day: both models start from one pass over the facts
    days = staged(intake.site_days(*_intake_tables(t), sites=SITES))
    day = intake.flux_day_until(intake.day_table(days), as_of=AS_OF)
    week = intake.flux_week_until_next(intake.week_table(days), as_of=AS_OF)
    return calendar.calendar_features_day(day), calendar.calendar_features_week(week)


def _target_rows(t: TestTables) -> DataFrame:
    return forecast.target_rows(*_forecast_tables(t), keys=SERIES, as_of=AS_OF)


@_query
def sequence_forecast(t: TestTables) -> DataFrame:
    rows = _target_rows(t)
    return forecast.predict(rows, forecast.fit_models(rows, keys=SERIES), keys=SERIES)


@_query
def forecast_quality(t: TestTables) -> DataFrame:
    """How good the forecast would have been on every past run, by horizon."""
    return _rounded(forecast.forecast_quality(_target_rows(t), keys=SERIES), places=4)


@_query
def forecast_run_log(t: TestTables) -> DataFrame:
    """A log row for each kind of the evaluated forecast."""
    quality = forecast.forecast_quality(_target_rows(t), keys=SERIES, by=["kind"])
    message = F.concat(F.lit("rmse "), "kind", F.lit(" "), F.round("rmse", 2).cast("decimal(20,2)").cast("string"))
    at = dt.datetime.combine(AS_OF, dt.time())
    return publish.run_log(quality.select(message.alias("log")), at=at, info="métrique", page="run final day")


#: Run dates of stored models; the last one lies after the run.
VERSIONS = tuple(AS_OF + dt.timedelta(days=7 * k) for k in (-8, -4, -1, 1))


@_query
def stored_model_forecast(t: TestTables) -> DataFrame:
    """The coming days as the newest model stored before the run predicts them."""
    rows = _target_rows(t)
    stored = forecast.model_versions(rows, keys=SERIES, run_dates=VERSIONS)
    models = forecast.models_as_of(stored, keys=SERIES, as_of=AS_OF)
    picked = models.select(*SERIES, "kind", "position", "version", "trained")
    daily = rows.filter("kind = 'day'")
    return forecast.predict(daily, models, keys=SERIES).join(picked, [*SERIES, "kind", "position"], "left")


@_query
def series_least_squares(t: TestTables) -> DataFrame:
    series = forecast.weekly_series(t.deliveries_all(), key="code_adherent")
    return _rounded(forecast.series_least_squares(series, key="code_adherent"), places=5)


@_query
def publish_forecast(t: TestTables) -> DataFrame:
    """A trend forecast published over the forecasts already stored."""
    monday = AS_OF + dt.timedelta(days=4)
    recent = t.forecast_daily(since=monday - dt.timedelta(days=14), until=monday)
    # twice the last week's value less the one before, a NULL where a day has neither
    last_week = F.col("jour") >= F.lit(monday - dt.timedelta(days=7))
    value = F.col("dt") * F.when(last_week, F.lit(2)).otherwise(F.lit(-1))
    weekday = F.weekday("jour")
    sums = recent.agg(*(F.sum(F.when(weekday == p, value)).alias(f"d{p}") for p in range(6)))
    days = publish.forecast_days(AS_OF)
    trend = sums.select(
        F.inline(F.array(*(F.struct(F.lit(day).alias("jour"), F.col(f"d{p}").alias("pred")) for p, day in enumerate(days))))
    )
    week = recent.agg(F.sum(F.when(weekday < 6, value)).alias("pred")).withColumn("jour", F.lit(monday))
    stored = t.forecast_daily().select(
        "jour", F.col("dt").alias("pred2"), F.when(F.dayofweek("jour") == 2, F.col("dt") * 6).alias("pred1")
    )
    new = publish.publish_forecast(trend, week, as_of=AS_OF)
    return publish.upsert_forecast(stored, new)


def _weekly_errors(t: TestTables) -> DataFrame:
    """Final weekly forecast beside the actual intake."""
    actual = weekly.weekly_intake(t.deliveries_all())
    return t.forecast_final().join(actual, weekly.WEEK)


@_query
def forecast_metrics(t: TestTables) -> DataFrame:
    metrics = comparison.forecast_metrics(
        _weekly_errors(t), predicted="pred", actual="quantite_recolte", keys=["annee"]
    )
    return _rounded(metrics, places=6)


@_query
def run_log(t: TestTables) -> DataFrame:
    metrics = comparison.forecast_metrics(_weekly_errors(t), predicted="pred", actual="quantite_recolte")
    message = F.concat(F.lit("rmse model 1 "), F.col("rmse").cast("int").cast("string"))
    at = dt.datetime.combine(AS_OF, dt.time())
    return publish.run_log(metrics.select(message.alias("log")), at=at, info="métrique", page="run final day")


@_query
def weekly_forecast_run(t: TestTables) -> DataFrame:
    """Features, windows, forecast and publication of the coming week for all sites."""
    predicted = sequence_forecast(t)
    daily = predicted.filter(F.col("kind") == "day")
    week = predicted.filter(F.col("kind") == "week")
    return publish.publish_forecast(daily, week, as_of=AS_OF, keys=SERIES)


@_query
def forecast_ledger(t: TestTables) -> DataFrame:
    """Every value that the run owes the growers' communes and the stations, with what became of it."""
    day, week = _forecast_tables(t)
    growers = t.growers()
    expected = growers.select("code_insee").union(growers.select("numero_station")).dropna()
    predicted = forecast.sequence_forecast(day, week, keys=SERIES, as_of=AS_OF)
    return publish.forecast_ledger(expected, predicted, day, week, as_of=AS_OF, keys=SERIES)


@_query
def calendar_between(t: TestTables) -> DataFrame:
    """The days between the first and the last delivery, without Sundays."""
    bounds = t.deliveries_all().agg(F.min("date_recolte"), F.max("date_recolte")).first()
    if bounds[0] is None:
        return t.calendar().limit(0)
    return intake.calendar_between(t.spark, *bounds)


@_query
def model_input(t: TestTables) -> DataFrame:
    """Features, target and exogenous features of the daily model, in long form."""
    found = calendar.model_input(_day_features(t))
    keys = [*SERIES, "date_recolte"]

    def long(part: str, df: DataFrame) -> DataFrame:
        values = [c for c in df.columns if c not in keys]
        doubles = df.select(*keys, *(F.col(c).cast("double").alias(c) for c in values))
        return doubles.unpivot(keys, values, "name", "value").withColumn("part", F.lit(part))

    parts = [long(part, df) for part, df in found._asdict().items()]
    return _rounded(parts[0].unionByName(parts[1]).unionByName(parts[2]), columns=["value"])


@_query
def rank_correlation(t: TestTables) -> DataFrame:
    features = ["t_min", "t_max", "ctmax", "ctmin", "cpluie"]
    return _rounded(
        comparison.rank_correlation(staged(flux_day_sites(t)), features=features, target="qte", keys=SERIES)
    )
