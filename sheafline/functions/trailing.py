"""Many trailing row-frame sums over one sort.

Spark evaluates a sliding frame by adding up its buffer again for each row, so a set of
trailing sums costs rows x frame length x columns. For exact types (integers, decimals)
the same result is the difference of two running sums, which costs O(1) per row and
column: one window pass keeps a running sum per source, a second pass over the same
partitioning and order reads it back at two offsets. Binary floats keep the sliding
frame, because differences of running sums would change their last digits.

Either way all columns share one exchange and one sort.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DecimalType, IntegralType


@dataclass(frozen=True)
class TrailingSum:
    """``name`` = sum of ``source`` over the rows ``start`` to ``end`` preceding."""

    source: str
    name: str
    start: int
    end: int = 1


def trailing_sums(
    df: DataFrame,
    partition: list[str],
    order: str,
    sums: Iterable[TrailingSum],
    *,
    extra: dict[str, Column] | None = None,
    exact: bool | None = None,
) -> DataFrame:
    """Append the ``sums`` (and ``extra`` window columns) to ``df``.

    A frame without a non-NULL value gives NULL. ``exact`` overrides the choice of
    method, which is made per source from its type.
    """
    sums = list(sums)
    spec = Window.partitionBy(*partition).orderBy(order)

    def running(source: str) -> bool:
        if exact is not None:
            return exact
        return isinstance(df.schema[source].dataType, (IntegralType, DecimalType))

    exact_sources = sorted({s.source for s in sums if running(s.source)})
    nullable = {source for source in exact_sources if df.schema[source].nullable}
    to_current = spec.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first: dict[str, Column] = dict(extra or {})
    for source in exact_sources:
        first[f"__sum_{source}"] = F.sum(F.coalesce(F.col(source), F.lit(0))).over(to_current)
        if source in nullable:
            first[f"__cnt_{source}"] = F.count(source).over(to_current)
    for s in sums:
        if s.source not in exact_sources:
            first[s.name] = F.sum(s.source).over(spec.rowsBetween(-s.start, -s.end))

    # each running value is read back once per distinct offset; SQL text, as building
    # hundreds of columns call by call takes longer than the work on a small table
    keys = ", ".join(f"`{c}`" for c in partition)
    over = f"OVER (PARTITION BY {keys} ORDER BY `{order}`)"
    second: dict[str, Column] = {}

    def at(value: str, offset: int) -> str:
        if not offset:
            return f"`{value}`"
        name = f"{value}_{offset}"
        if name not in second:
            second[name] = F.expr(f"lag(`{value}`, {offset}) {over}")
        return f"`{name}`"

    def difference(value: str, s: TrailingSum) -> str:
        return f"{at(value, s.end)} - coalesce({at(value, s.start + 1)}, 0)"

    results: list[Column] = []
    for s in sums:
        if s.source not in exact_sources:
            results.append(F.col(s.name))
            continue
        text = difference(f"__sum_{s.source}", s)
        if s.source in nullable:
            text = f"CASE WHEN {difference(f'__cnt_{s.source}', s)} > 0 THEN {text} END"
        results.append(F.expr(text).alias(s.name))
    return df.withColumns(first).withColumns(second).select(*df.columns, *(extra or {}), *results)
