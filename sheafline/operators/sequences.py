"""Past/future training windows cut from daily and weekly series.

One row per sample, with the past as an array of feature rows. Rows are numbered from 0
inside a series; frames are bounded and stay inside it. NULLs inside a window are kept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

# fixed values: rows of the past, rows between anchor and first target, rows of the future
DAY_PAST, DAY_GAP, DAY_FUTURE = 12, 3, 6
# fixed values: the six weeks before the running week, which is not yet complete
WEEK_FIRST, WEEK_LAST = 7, 2


def _row(columns: Sequence[str]) -> Column:
    return F.array(*(F.col(c).cast("double") for c in columns))


def _numbered(df: DataFrame, keys: Sequence[str], order: str) -> tuple[DataFrame, WindowSpec]:
    spec = Window.partitionBy(*keys).orderBy(order)
    return df.withColumn("sample", F.row_number().over(spec) - 1), spec


def sequence_windows_day(
    df: DataFrame,
    *,
    keys: Sequence[str],
    order: str,
    features: Sequence[str],
    target: str,
    step: int = DAY_FUTURE,
    anchored: str = "start",
) -> DataFrame:
    """Samples every ``step`` rows: 12 past rows, and 6 future rows after a gap of 3.

    ``past`` holds all features, ``future`` all but the target, ``target`` the future
    target values, ``days`` the future values of ``order``. Samples are counted from the
    ``start`` of the series, or from its ``end``: then the last one's future ends at the
    last row, whatever the number of rows. Samples whose future is cut by the end of the
    series are left out.
    """
    if anchored not in ("start", "end"):
        raise ValueError(f"samples are anchored at the start or the end, not at {anchored!r}")
    numbered, _ = _numbered(df, keys, order)
    numbered = numbered.withColumn("__rows", F.count(F.lit(1)).over(Window.partitionBy(*keys)).cast("int"))
    place, rows = F.col("sample"), F.col("__rows")
    last = F.lit(DAY_GAP + DAY_FUTURE - 1)
    phase = F.lit(DAY_PAST) if anchored == "start" else rows - 1 - last

    def sent(first: Column, end: Column, part: str) -> Column:
        """The row for each anchor between ``first`` and ``end``: the part and the place that it takes."""
        nearest = first + F.pmod(phase - first, F.lit(step))
        anchors = F.when(nearest <= end, F.sequence(nearest, end, F.lit(step))).otherwise(F.array().cast("array<int>"))
        return F.transform(anchors, lambda anchor: F.struct(anchor.alias("anchor"), F.lit(part).alias("part")))

    # a row goes to the few anchors that use it, not every anchor's rows to every row
    receivers = F.concat(sent(place + 1, place + DAY_PAST, "past"), sent(place - last, place - DAY_GAP, "future"))
    entry = F.struct("__place", "__row", "__day")
    grouped = (
        numbered.select(*keys, "__rows", place.alias("__place"), _row([*features, target]).alias("__row"), F.col(order).alias("__day"), F.inline(receivers))
        .filter((F.col("anchor") >= DAY_PAST) & (F.col("anchor") + last < rows))
        .groupBy(*keys, F.col("anchor").alias("sample"))
        .agg(
            F.array_sort(F.collect_list(F.when(F.col("part") == "past", entry))).alias("past"),
            F.array_sort(F.collect_list(F.when(F.col("part") == "future", entry))).alias("future"),
        )
    )
    count = len(features)
    exogenous = [k for k, name in enumerate(features) if name != target]
    return grouped.select(
        *keys,
        "sample",
        F.transform("past.__row", lambda row: F.slice(row, 1, count)).alias("past"),
        F.transform("future.__row", lambda row: F.array(*(row[k] for k in exogenous))).alias("future"),
        F.transform("future.__row", lambda row: row[count]).alias("target"),
        F.col("future.__day").alias("days"),
    )


def sequence_windows_week(
    df: DataFrame, *, keys: Sequence[str], order: str, features: Sequence[str], target: str
) -> DataFrame:
    """A sample per week: six past weeks without the running one, and the week itself."""
    numbered, spec = _numbered(df, keys, order)
    exogenous = [f for f in features if f != target]
    return numbered.select(
        *keys,
        "sample",
        F.collect_list(_row(features)).over(spec.rowsBetween(-WEEK_FIRST, -WEEK_LAST)).alias("past"),
        F.array(_row(exogenous)).alias("future"),
        F.array(F.col(target).cast("double")).alias("target"),
        F.array(order).alias("days"),
    ).filter(F.col("sample") >= WEEK_FIRST)


def latest_window(samples: DataFrame, *, keys: Sequence[str]) -> DataFrame:
    """Samples with ``is_score``: true for the last one of a series, the one to predict."""
    last = F.max("sample").over(Window.partitionBy(*keys))
    return samples.withColumn("is_score", F.col("sample") == last)


def sequence_rows(
    samples: DataFrame, *, keys: Sequence[str], features: Sequence[str], target: str
) -> DataFrame:
    """Samples in long form: a row per sample, part ('past' or 'future') and step."""
    exogenous = [f for f in features if f != target]

    def entry(part: str, step: Column, values: dict[str, Column]) -> Column:
        return F.struct(
            F.lit(part).alias("part"),
            step.cast("int").alias("step"),
            *(values[f].alias(f) for f in features),
        )

    past = F.transform(
        "past", lambda row, i: entry("past", i, {f: row[k] for k, f in enumerate(features)})
    )
    future = F.transform(
        "future",
        lambda row, i: entry(
            "future", i, {target: F.col("target")[i], **{f: row[k] for k, f in enumerate(exogenous)}}
        ),
    )
    return samples.select(*keys, "sample", F.inline(F.concat(past, future)))
