"""Ridge regression from mergeable sums.

A table of moments has, for each key, the number of rows, the sums and products of all
features and the target, and the bounds of each feature. Tables of disjoint rows add up:
days, weeks or partitions are reduced once, and any span of them is fitted from its sums,
never from its rows. The system of normal equations is solved in expressions, one row per
key, so a fit is part of the plan that scores with it.

Features are penalised as if each were scaled to [-1, 1] by its bounds. A feature that is
constant, or a key with fewer than ``least`` rows, has no effect and no model.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from sheafline.functions import ratio

REGULARISATION = 0.01
LEAST_ROWS = 12


def _names(count: int) -> tuple[list[str], list[str], list[str]]:
    """Columns that add up, and those of which the least and the greatest are kept."""
    sums = [f"s{i}" for i in range(count + 1)]
    sums += [f"p{i}_{j}" for i in range(count + 1) for j in range(i, count + 1)]
    return ["n", *sums], [f"low{i}" for i in range(count)], [f"high{i}" for i in range(count)]


def moment_rows(rows: DataFrame, *, features: Sequence[str], target: str) -> DataFrame:
    """``rows`` with the moments of each row alone; NULL in a row with any value missing."""
    values = [F.col(c).cast("double") for c in (*features, target)]
    known = values[0].isNotNull()
    for value in values[1:]:
        known = known & value.isNotNull()

    def kept(value: Column) -> Column:
        return F.when(known, value)

    columns = {"n": kept(F.lit(1).cast("bigint"))}
    for i, value in enumerate(values):
        columns[f"s{i}"] = kept(value)
        for j in range(i, len(values)):
            columns[f"p{i}_{j}"] = kept(value * values[j])
    for i, value in enumerate(values[:-1]):
        columns[f"low{i}"] = columns[f"high{i}"] = kept(value)
    return rows.withColumns(columns)


def merged_moments(moments: DataFrame, *, keys: Sequence[str], features: Sequence[str]) -> DataFrame:
    """Moments of all rows of each key together, from moments of rows or of parts."""
    sums, lows, highs = _names(len(features))
    return moments.groupBy(*keys).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        *(F.sum(c).alias(c) for c in sums[1:]),
        *(F.min(c).alias(c) for c in lows),
        *(F.max(c).alias(c) for c in highs),
    )


def running_moments(moments: DataFrame, *, keys: Sequence[str], order: Sequence[str], features: Sequence[str]) -> DataFrame:
    """Each row with the moments of the rows of its key up to itself.

    A key's rows are ordered in one task and must be bounded by the calendar.
    """
    sums, lows, highs = _names(len(features))
    so_far = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return moments.withColumns(
        {c: F.sum(c).over(so_far) for c in sums}
        | {c: F.min(c).over(so_far) for c in lows}
        | {c: F.max(c).over(so_far) for c in highs}
    )


def solved(moments: DataFrame, *, features: Sequence[str], penalty: float = REGULARISATION, least: int = LEAST_ROWS) -> DataFrame:
    """Moments replaced by ``trained`` (rows), ``mean`` of the target, ``means`` and ``coefficients`` of the features.

    There is no row for a key with fewer than ``least`` rows. The equations are an array of rows, reduced one unknown at a time. They are positive definite,
    so no rows need to change places.
    """
    count = len(features)
    others = [c for c in moments.columns if c not in {c for names in _names(count) for c in names}]
    n = F.col("n")

    def moving(i: int) -> Column:
        return F.col(f"high{i}") > F.col(f"low{i}")

    def entry(i: int, j: int) -> Column:
        # sums of products about the means; a constant feature leaves an equation of its own
        low, high = min(i, j), max(i, j)
        product = F.col(f"p{low}_{high}") - F.col(f"s{low}") * F.col(f"s{high}") / n
        if i == j:
            half = (F.col(f"high{i}") - F.col(f"low{i}")) / 2
            return F.when(moving(i), product + F.lit(penalty) * n * half * half).otherwise(F.lit(1.0))
        both = moving(i) & moving(j) if j < count else moving(i)
        return F.when(both, product).otherwise(F.lit(0.0))

    system = F.array(*(F.array(*(entry(i, j) for j in range(count + 1))) for i in range(count)))

    def without(rows: Column, k: Column) -> Column:
        """The equations with unknown ``k`` in the k-th alone."""
        pivot = F.transform(rows[k], lambda value: ratio(value, rows[k][k]))
        return F.transform(
            rows,
            lambda row, i: F.when(i == k, pivot).otherwise(F.zip_with(row, pivot, lambda value, p: value - row[k] * p)),
        )

    reduced = F.aggregate(F.sequence(F.lit(0), F.lit(count - 1)), system, without)
    means = F.array(*(F.col(f"s{i}") / n for i in range(count)))
    coefficients = F.transform(reduced, lambda row: row[count])
    return moments.filter(n >= least).select(
        *others,
        n.alias("trained"),
        (F.col(f"s{count}") / n).alias("mean"),
        means.alias("means"),
        coefficients.alias("coefficients"),
    )


def predicted(features: Sequence[str]) -> Column:
    """The value that ``mean``, ``means`` and ``coefficients`` of a row give for its features.

    A missing feature has no effect: its mean stands for it.
    """
    value = F.col("mean")
    for i, name in enumerate(features):
        away = F.col(name).cast("double") - F.col("means")[i]
        value = value + F.coalesce(F.col("coefficients")[i] * away, F.lit(0.0))
    return F.when(F.col("trained").isNotNull(), value)
