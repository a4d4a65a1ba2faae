"""Schemas, readers and writers of the source tables."""

from sheafline.sources.sinks import append_rows, merged_partitions, upsert_partitions, write_new
from sheafline.sources.staging import shared, staged
from sheafline.sources.tables import SCHEMAS, read_table

__all__ = ["SCHEMAS", "append_rows", "merged_partitions", "read_table", "shared", "staged", "upsert_partitions", "write_new"]
