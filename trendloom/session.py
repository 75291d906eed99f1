"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile

from pyspark.sql import SparkSession

from .plans.staging import Stage

# Settings the operators rely on; all of them can be changed on a live session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: str = "8", app: str = "trendloom", **extra: str) -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in {**RUNTIME_CONF, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application.

    Functions that run in Python workers refer to its modules, so the workers
    must be able to import it from any working directory.
    """
    sc = spark.sparkContext
    if getattr(sc, "_trendloom_shipped", False):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="trendloom-ship-")
    archive = os.path.join(folder, "trendloom.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for where, _, files in os.walk(here):
            for name in sorted(files):
                if name.endswith(".py"):
                    path = os.path.join(where, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(here)))
    sc.addPyFile(archive)  # served to the executors from here, so it stays until the driver ends
    atexit.register(shutil.rmtree, folder, True)
    sc._trendloom_shipped = True


def staged(df):
    """Compute ``df`` once, as Parquet in the shared folder, and cut its lineage.

    Meant for small, expensive results that feed several outputs.
    """
    return Stage(df.sparkSession, "staged").write(df)


def unstage(df) -> None:
    """Delete a table that ``staged`` wrote and nothing reads any more."""
    Stage(df.sparkSession, "staged").discard(df)
