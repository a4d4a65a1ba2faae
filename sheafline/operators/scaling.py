"""Min-max scaling to [-1, 1] with stored statistics.

Statistics are a table: one row per series (``keys``), or a single row without keys.
They can be written and read back, which replaces a stored scaler.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from sheafline.functions import ratio

Bounds = dict[str, tuple[Column, Column]]


def minmax_fit(df: DataFrame, columns: Iterable[str], *, keys: Sequence[str] = ()) -> DataFrame:
    """Minimum and maximum of each column, NULLs ignored: ``min_<column>``, ``max_<column>``."""
    aggregates = []
    for c in columns:
        value = F.col(c).cast("double")
        aggregates += [F.min(value).alias(f"min_{c}"), F.max(value).alias(f"max_{c}")]
    return df.groupBy(*keys).agg(*aggregates)


def _scaled(name: str, low: Column, high: Column) -> Column:
    value = F.col(name).cast("double")
    return F.when(value.isNotNull() & (low == high), F.lit(-1.0)).otherwise(
        ratio(value - low, high - low) * 2 - 1
    )


def _unscaled(name: str, low: Column, high: Column) -> Column:
    return (F.col(name) + 1) / 2 * (high - low) + low


def _with_bounds(
    df: DataFrame, stats: DataFrame, columns: Sequence[str], keys: Sequence[str]
) -> tuple[DataFrame, Bounds]:
    names = [f"{side}_{c}" for c in columns for side in ("min", "max")]
    if keys:
        joined = df.join(stats.select(*keys, *names), list(keys), "left")
        return joined, {c: (F.col(f"min_{c}"), F.col(f"max_{c}")) for c in columns}
    # a single row of statistics enters as one scalar subquery, not as a join
    wide = df.withColumn("__stats", stats.select(F.struct(*names)).scalar())
    return wide, {c: (F.col(f"__stats.min_{c}"), F.col(f"__stats.max_{c}")) for c in columns}


def minmax_apply(
    df: DataFrame, stats: DataFrame, columns: Sequence[str], *, keys: Sequence[str] = ()
) -> DataFrame:
    """Columns scaled with stored statistics; a constant column gives -1, NULL stays NULL."""
    wide, bounds = _with_bounds(df, stats, columns, keys)
    return wide.withColumns({c: _scaled(c, *bounds[c]) for c in columns}).select(*df.columns)


def minmax_scale(df: DataFrame, columns: Sequence[str], *, keys: Sequence[str] = ()) -> DataFrame:
    """Columns scaled with the statistics of ``df`` itself.

    With keys the bounds are taken over the series' own partition, in the shuffle that
    sequence windows by the same keys need anyway; the input is computed once.
    """
    if not keys:
        return minmax_apply(df, minmax_fit(df, columns), columns)
    series = Window.partitionBy(*keys)
    scaled = {}
    for c in columns:
        value = F.col(c).cast("double")
        scaled[c] = _scaled(c, F.min(value).over(series), F.max(value).over(series))
    return df.withColumns(scaled)


def minmax_inverse(
    df: DataFrame,
    stats: DataFrame,
    columns: Sequence[str],
    *,
    keys: Sequence[str] = (),
    truncate: bool = True,
) -> DataFrame:
    """Scaled columns in original units, cut toward zero to whole numbers by default."""
    wide, bounds = _with_bounds(df, stats, columns, keys)
    restored = {c: _unscaled(c, *bounds[c]) for c in columns}
    if truncate:
        restored = {c: value.cast("bigint") for c, value in restored.items()}
    return wide.withColumns(restored).select(*df.columns)
