"""Cutting lineage so that a lost executor costs a re-read, not a re-run.

Tables are written as Parquet to the shared folder named by
``spark.checkpoint.dir``.  Only where that setting is empty (unit tests, a
notebook on one machine) a folder of our own is used.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

_written: set[str] = set()
_own_folder: str | None = None


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors share, from the session; on one machine, where it is unset, one of our own.

    On a cluster without the setting RuntimeError is raised: executors would
    write to their own disks what none of the others could read.
    """
    global _own_folder
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    if _own_folder is None:
        _own_folder = "file://" + tempfile.mkdtemp(prefix="millrace-")
    return _own_folder


def _remove(path: str) -> None:
    try:
        context = SparkContext._active_spark_context
        target = context._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the session is gone; only local folders can still be reached
        if path.startswith(("file:", "/")):
            shutil.rmtree(path.removeprefix("file://").removeprefix("file:"), ignore_errors=True)


def release() -> None:
    """Removes all tables written so far; results that haven't been computed yet can't be afterwards."""
    for path in list(_written):
        _remove(path)
        _written.discard(path)


def materialise(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once and return a DataFrame that reads it back.

    The result has the columns and rows of ``df``; an empty ``df`` keeps its
    schema.  The files are removed when the Python process ends, or by :func:`release`.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/millrace/{label}-{uuid.uuid4().hex}"
    if not _written:
        # Handlers run last in, first out: registered now, this one still finds the context.
        atexit.unregister(release)
        atexit.register(release)
    _written.add(path)
    df.write.option("compression", "zstd").parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._millrace_path = path
    return back


def discard(df: DataFrame) -> None:
    """Removes the table behind a result of :func:`materialise` at once, when nothing is to be computed from it any more."""
    path = getattr(df, "_millrace_path", None)
    if path in _written:
        _remove(path)
        _written.discard(path)
