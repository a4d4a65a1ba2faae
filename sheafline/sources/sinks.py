"""Writers. A stored file is never overwritten while a plan reads it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, functions as F

from sheafline.sources.staging import staged


def write_new(df: DataFrame, path: str) -> None:
    """Write a full table to a path that must not exist yet."""
    df.write.mode("errorifexists").parquet(path)


def append_rows(df: DataFrame, path: str) -> None:
    """Add rows to a stored table."""
    df.write.mode("append").parquet(path)


def merged_partitions(new: DataFrame, path: str, *, keys: Sequence[str], partition: str) -> DataFrame:
    """What the partitions that ``new`` touches hold after the update, from those partitions alone.

    A row of ``new`` takes the place of the stored row with the same ``keys``, NULL equal to NULL.
    Where nothing is stored yet this is ``new``.
    """
    # the days of a forecast: a handful, whatever is stored
    touched = [row[0] for row in new.select(partition).distinct().collect()]
    try:
        stored = new.sparkSession.read.schema(new.schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return new
    known = [value for value in touched if value is not None]
    within = F.col(partition).isin(known)
    if len(known) < len(touched):
        within = within | F.col(partition).isNull()
    named = new.select(*(F.col(k).alias(f"__new_{k}") for k in keys))
    same = [F.col(k).eqNullSafe(F.col(f"__new_{k}")) for k in keys]
    kept = stored.filter(within).join(named, same, "left_anti")
    return kept.select(*new.columns).unionByName(new)


def upsert_partitions(new: DataFrame, path: str, *, keys: Sequence[str], partition: str) -> None:
    """Rows of ``new`` in place of stored ones with the same ``keys``; other partitions keep their files.

    The table is stored by ``partition``, which is one of the keys. Only partitions that ``new``
    has are read and rewritten. The merged rows are staged first, so a run that fails has changed
    nothing or only whole partitions, and the same run again gives the same table.
    """
    if partition not in keys:
        raise ValueError(f"a row is found by {list(keys)}, which must hold the partition {partition!r}")
    merged = staged(merged_partitions(staged(new), path, keys=keys, partition=partition))
    writer = merged.repartition(partition).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(partition).parquet(path)
