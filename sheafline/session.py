"""A session with the settings the operators are written for."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(app: str = "sheafline", *, cpus: int | None = None, memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks.

    On a cluster use its own session: the operators need nothing beyond Spark's
    defaults, with adaptive execution (coalesced shuffles, skewed joins split) left on
    and the time zone of the stored days.
    """
    cores = cpus or os.cpu_count() or 1
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # plans are built from many columns: do not look up a call site for each
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
