"""Intermediate tables: written once as Parquet in the shared folder, dropped after use."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where the setting is absent a local session gets a folder of its own, which
    goes at exit; a cluster has to name one that all executors share.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="trendloom-shared-")
    atexit.register(shutil.rmtree, folder, True)
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


class Stage:
    """The intermediate tables of one run, below the shared folder.

    ``write`` computes a table once and cuts its lineage: what reads it later
    survives lost executors without recomputing. ``drop`` deletes a table that
    nothing reads any more.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"
        self._tables = 0

    def write(self, df: DataFrame, *partition_by: str) -> DataFrame:
        path = f"{self.root}/{self._tables:04d}"
        self._tables += 1
        writer = df.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self._last = path
        return out

    def drop(self, df: DataFrame) -> None:
        """Delete a table of this run."""
        self._delete(df, self.root)

    def discard(self, df: DataFrame) -> None:
        """Delete a table that another run has left below the shared folder."""
        self._delete(df, shared_folder(self.spark))

    def _delete(self, df: DataFrame, below: str) -> None:
        files = df.inputFiles()
        if not files:
            return
        path = files[0].rsplit("/", 1)[0]
        if below.split(":")[-1].strip("/") not in path:
            raise ValueError(f"{path} does not lie below {below}")
        jvm = self.spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
