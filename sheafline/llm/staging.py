"""Cutting the lineage of frames that several jobs read."""

from __future__ import annotations

import gc
import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def _folder(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``, where files outlive a lost executor.

    Only a local session without that setting, as in a test, gets a folder made here; on a
    cluster a folder of one machine would not do, and it is an error.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir")
        if folder is None and not context.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="sheafline-"))
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` in the checkpoint folder."""
    _folder(df.sparkSession)
    return df.checkpoint()


def clean(spark: SparkSession) -> None:
    """Have Spark delete shuffle files and checkpoints of frames that are not used any more.

    It does so when the driver's garbage is collected, which may be long after many small jobs;
    the driver's heap shrinks as well.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


class Tables:
    """Tables of one job in the checkpoint folder: compressed, for frames as large as the documents.

    They are deleted together, by ``drop`` or at the end of a ``with`` block, where nothing may
    read them any more. Without either they stay.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.folder = f"{_folder(spark)}/{uuid4().hex}"

    def stored(self, df: DataFrame) -> DataFrame:
        path = f"{self.folder}/{uuid4().hex}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        clean(self.spark)

    def __enter__(self) -> Tables:
        return self

    def __exit__(self, *error: object) -> None:
        self.drop()
