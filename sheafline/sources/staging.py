"""Frames that several jobs, or several branches of one plan, read."""

from __future__ import annotations

import tempfile

from pyspark import StorageLevel
from pyspark.sql import DataFrame


def shared(df: DataFrame) -> DataFrame:
    """``df`` kept by the executors, spilling to disk, for several branches or passes.

    Branches that prune different columns do not share an exchange, so each would read
    the fact table again. A lost executor's part is recomputed. Frames that stay must be
    calendar-sized; larger ones are for the caller to unpersist.
    """
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def staged(df: DataFrame) -> DataFrame:
    """``df`` written to the checkpoint folder, so that later jobs do not recompute it.

    The folder is the one the session names in ``spark.checkpoint.dir``; files there
    outlive an executor. A session without one must be local, as in tests, and gets a
    temporary folder; on a cluster it fails, as a folder of one machine would not do.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir")
        if folder is None and not context.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="sheafline-"))
    return df.checkpoint()
