"""Session defaults, table access and the package's way to the executors."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("millrace")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def _pack(target: str) -> None:
    package = os.path.dirname(os.path.abspath(__file__))
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, os.path.dirname(package)))


def ship(spark: SparkSession) -> None:
    """Sends this package to the session's Python workers, once; they needn't have it installed."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    folder = tempfile.mkdtemp(prefix="millrace-")  # on the driver only: Spark takes the file from here
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    packed = os.path.join(folder, "millrace.zip")
    _pack(packed)
    context.addPyFile(packed)
    _shipped.add(context.applicationId)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """``folder/name.parquet``, a file or a directory of part files."""
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")
