"""Publishing the coming week's forecast, and the run log."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from sheafline.functions.dates import as_date
from sheafline.operators.sequences import DAY_GAP, DAY_PAST, WEEK_FIRST

# fixed values: the run is on a Thursday; the six forecast days start four days later
RUN_WEEKDAY = 3
FIRST_DAY_OFFSET = 4
FORECAST_DAYS = 6

LOG_COLUMNS = ("timest", "ml", "info", "log", "page")


def forecast_days(as_of: dt.date | str) -> list[dt.date]:
    """Monday to Saturday after a Thursday."""
    day = as_date(as_of)
    if day.weekday() != RUN_WEEKDAY:
        raise ValueError(f"forecasts are published on a Thursday, {day} is none")
    return [day + dt.timedelta(days=FIRST_DAY_OFFSET + k) for k in range(FORECAST_DAYS)]


def publish_forecast(
    daily: DataFrame, weekly: DataFrame, *, as_of: dt.date | str, keys: Sequence[str] = ()
) -> DataFrame:
    """Rows (keys, jour, pred2, pred1) for Monday to Saturday after a Thursday.

    ``daily`` and ``weekly`` have (keys, jour, pred): the day each value was made for, the Monday
    for a week. Values of other days are not published; a series that lacks one of the six
    days, or has one twice, is an error. A missing daily value counts as 0 and a negative one is
    raised to 0; the weekly value goes on the Monday unchanged.
    """
    days = forecast_days(as_of)
    wanted = F.col("jour").isin(days)
    # both kinds meet by day in one grouping
    missing = F.lit(None).cast("bigint")
    parts = daily.filter(wanted).select(
        *keys, "jour", F.lit(1).alias("days"),
        F.coalesce(F.col("pred"), F.lit(0)).cast("bigint").alias("pred2"), missing.alias("pred1"),
    ).unionByName(
        weekly.filter(F.col("jour") == F.lit(days[0])).select(
            *keys, "jour", F.lit(0).alias("days"),
            missing.alias("pred2"), F.col("pred").cast("bigint").alias("pred1"),
        )
    )
    rows = parts.groupBy(*keys, "jour").agg(
        F.sum("days").alias("days"), F.max("pred2").alias("pred2"), F.max("pred1").alias("pred1")
    )
    # six rows per series
    series = Window.partitionBy(*keys)
    complete = (F.sum("days").over(series) == FORECAST_DAYS) & (F.count("pred2").over(series) == FORECAST_DAYS)
    checked = F.when(complete, F.greatest(F.col("pred2"), F.lit(0))).otherwise(
        F.raise_error(F.lit(f"a forecast needs {FORECAST_DAYS} days, {days[0]} to {days[-1]}"))
    )
    return rows.select(*keys, "jour", checked.alias("pred2"), "pred1")


def upsert_forecast(stored: DataFrame, new: DataFrame, *, keys: Sequence[str] = ("jour",)) -> DataFrame:
    """The stored table with the new rows in place of those with the same key.

    The result is a full table for a new path; the stored one is not touched. To update a
    large stored table in place, day by day, use ``sources.upsert_partitions``.
    """
    kept = stored.join(new.select(*keys), list(keys), "left_anti")
    return kept.unionByName(new)


def forecast_ledger(
    expected: DataFrame, forecasts: DataFrame, day: DataFrame, week: DataFrame, *, as_of: dt.date | str, keys: Sequence[str]
) -> DataFrame:
    """What became of every value that a run had to give: (keys, kind, jour, pred, published, reason).

    ``expected`` has the series that must be forecast, ``forecasts`` (keys, kind, jour, pred), ``day``
    and ``week`` are the tables that the forecast was made from. Each series has six days and a
    week. ``reason`` is ``forecast``, ``negative`` (published as 0 on a day), ``no model`` (too few known
    targets; published as 0 on a day), ``day missing`` or ``week missing`` (the series ends before or after
    it), ``too short`` (no full window), or ``unknown`` (the series has no row).
    """
    days = forecast_days(as_of)
    wanted = [F.struct(F.lit("day").alias("kind"), F.lit(d).alias("jour")) for d in days]
    wanted.append(F.struct(F.lit("week").alias("kind"), F.lit(days[0]).alias("jour")))
    spine = expected.select(*keys).distinct().select(*keys, F.inline(F.array(*wanted)))
    lengths = _lengths(day, "day", keys).unionByName(_lengths(week, "week", keys))
    made = forecasts.select(*keys, "kind", "jour", "pred", F.lit(True).alias("made"))
    found = spine.join(made, [*keys, "kind", "jour"], "left").join(lengths, [*keys, "kind"], "left")
    pred, daily = F.col("pred"), F.col("kind") == "day"
    least = F.when(daily, F.lit(DAY_PAST + DAY_GAP + FORECAST_DAYS)).otherwise(F.lit(WEEK_FIRST + 1))
    reason = (
        F.when(daily & (pred < 0), F.lit("negative"))
        .when(pred.isNotNull(), F.lit("forecast"))
        .when(F.col("made"), F.lit("no model"))
        .when(F.col("rows").isNull(), F.lit("unknown"))
        .when(F.col("rows") < least, F.lit("too short"))
        .otherwise(F.concat("kind", F.lit(" missing")))
    )
    published = F.when(daily & F.col("made"), F.greatest(F.coalesce(pred, F.lit(0)), F.lit(0))).otherwise(pred)
    return found.select(*keys, "kind", "jour", "pred", published.alias("published"), reason.alias("reason"))


def _lengths(table: DataFrame, kind: str, keys: Sequence[str]) -> DataFrame:
    return table.groupBy(*keys).agg(F.lit(kind).alias("kind"), F.count(F.lit(1)).alias("rows"))


def run_log(messages: DataFrame, *, at: dt.datetime, info: str, page: str, ml: str = "cf") -> DataFrame:
    """Log rows (timest, ml, info, log, page) from a frame with a ``log`` column.

    ``at`` is the time of the run; a time without a zone is in UTC.
    """
    moment = at if at.tzinfo else at.replace(tzinfo=dt.timezone.utc)
    return messages.withColumns(
        {
            "timest": F.lit(int(moment.timestamp())).cast("bigint"),
            "ml": F.lit(ml),
            "info": F.lit(info),
            "page": F.lit(page),
        }
    ).select(*LOG_COLUMNS)
