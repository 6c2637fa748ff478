"""Writing the pipeline's outputs.  A failed write fails the job."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def write_text(df: DataFrame, path: str, by: str | None = None, column: str = "value", mode: str = "errorifexists") -> None:
    """One line a row, a folder for each value of ``by``."""
    writer = df.select(*([by] if by else []), F.col(column).alias("value")).write.mode(mode)
    (writer.partitionBy(by) if by else writer).text(path)


def write_json_lines(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One object a line, letters beyond ASCII as they are."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_parquet(df: DataFrame, path: str, by: list[str] | None = None, max_rows_per_file: int | None = None, mode: str = "errorifexists") -> None:
    writer = df.write.mode(mode)
    if by:
        writer = writer.partitionBy(*by)
    if max_rows_per_file:
        writer = writer.option("maxRecordsPerFile", max_rows_per_file)
    writer.parquet(path)


def write_by_origin(df: DataFrame, path: str, origin: str, mode: str = "errorifexists") -> None:
    """A folder for each file the rows came from; a file of which nothing is left gets none."""
    named = df.withColumn("origin", F.element_at(F.split(F.col(origin), "/"), -1)).drop(*([origin] if origin != "origin" else []))
    write_parquet(named, path, ["origin"], mode=mode)


def compact(spark: SparkSession, source: str, target: str, files: int, mode: str = "errorifexists") -> None:
    """The rows of ``source`` in about ``files`` files."""
    spark.read.parquet(source).repartition(files).write.mode(mode).parquet(target)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a finished output is there."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path + "/_SUCCESS")
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def has_parts(spark: SparkSession, path: str) -> bool:
    """Whether a folder is there and has something in it."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.exists(target) and len(system.listStatus(target)) > 0


def run_files(spark: SparkSession, source: str, make: Callable[[DataFrame], DataFrame], target: str, overwrite: bool = False, at_once: int = 1000) -> int:
    """Makes, file by file of the folder ``source``, what isn't yet under ``target``; the number of files made.

    ``make`` turns the rows of Parquet files into rows.  Files are taken
    ``at_once`` together in one job, each into its own folder
    ``origin=<file name>``; a folder is moved to its place when the job has
    ended, so a file whose folder is there is done, and one whose rows all fell
    out has an empty folder.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    system = at(source).getFileSystem(conf)
    out = at(target).getFileSystem(conf)
    files = sorted(f.getPath().toString() for f in system.listStatus(at(source)) if f.isFile() and not f.getPath().getName().startswith(("_", ".")))
    place = lambda path: f"{target}/origin={path.rsplit('/', 1)[1]}"
    todo = [f for f in files if overwrite or not out.exists(at(place(f)))]
    for first in range(0, len(todo), at_once):
        part = todo[first : first + at_once]
        passing = f"{target}/_passing"
        out.delete(at(passing), True)
        rows = spark.read.parquet(*part).withColumn("origin", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1))
        make(rows).write.partitionBy("origin").parquet(passing)
        for f in part:
            made = at(f"{passing}/{place(f).rsplit('/', 1)[1]}")
            out.delete(at(place(f)), True)
            if not (out.exists(made) and out.rename(made, at(place(f)))):
                out.mkdirs(at(place(f)))
        out.delete(at(passing), True)
    return len(todo)


def run_stage(spark: SparkSession, make, path: str, overwrite: bool = False) -> DataFrame:
    """The output at ``path``, made by ``make()`` unless it is there; an unfinished one is made anew."""
    if overwrite or not exists(spark, path):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def observed(df: DataFrame, name: str, **metrics) -> tuple[DataFrame, Observation]:
    """``df`` and an observation of ``rows`` and the given aggregates, filled by the first action on it."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *[m.alias(k) for k, m in metrics.items()]), seen
