"""Reading the pipeline's inputs."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.dates import iso_monday, parse_snapshot, snapshot_parts, snapshot_path
from millrace.functions.text import strip
from millrace.schemas import RAW_HTML, struct


def snapshot_index(spark: SparkSession, path: str) -> DataFrame:
    """The crawl's list of snapshots, a JSON array of objects with an ``id``."""
    return spark.read.schema("id STRING, name STRING").json(path, multiLine=True)


def select_snapshots(index: DataFrame, start: str, end: str, prefix: str = "https://data.commoncrawl.org") -> DataFrame:
    """``snapshot_id, warc_path, monday`` of snapshots from week ``start`` to ``end`` (``YYYY-WW``), both included.

    Ids without exactly a year and a week after their two names, of years
    before 2013 or of weeks that don't exist are left out.  A start after the
    end raises ValueError.
    """
    first, last = parse_snapshot(start)[0], parse_snapshot(end)[0]
    if first > last:
        raise ValueError(f"start {start!r} is after end {end!r}")
    year, week = snapshot_parts("id")
    return (
        index.select(year.alias("_year"), week.alias("_week"))
        .withColumn("monday", iso_monday(F.col("_year"), F.col("_week")))
        .filter((F.col("_year") >= 2013) & F.col("monday").between(F.lit(first), F.lit(last)))
        .select(
            F.format_string("%d-%02d", "_year", "_week").alias("snapshot_id"),
            snapshot_path(prefix, F.col("_year"), F.col("_week")).alias("warc_path"),
            "monday",
        )
    )


def archive_urls(lines: DataFrame, prefix: str, column: str = "value") -> DataFrame:
    """``lines`` with ``url``: the prefix and each non-empty line, resolved like a relative reference at the root."""
    base = prefix.rstrip("/")
    line = F.col(column)
    return lines.filter(line != "").withColumn(
        "url", F.when(line.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), line).otherwise(F.concat(F.lit(base + "/"), F.regexp_replace(line, "^/+", "")))
    )


def path_lists(spark: SparkSession, path: str, prefix: str) -> DataFrame:
    """``snapshot_file, value, url`` of ``*.paths.gz`` lists; Spark unpacks gzip by the file's name."""
    lines = spark.read.text(path).withColumn("snapshot_file", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1))
    return archive_urls(lines, prefix).select("snapshot_file", "value", "url")


def _lines_in_order(spark: SparkSession, path: str) -> tuple[DataFrame, list]:
    """Stripped lines, and what orders them by file and line: a task reads the lines of a split in turn, so
    within one the increasing ids do; splits go by their place in the file, whatever partition they came in."""
    lines = spark.read.text(path).select(
        strip("value").alias("value"), F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_line")
    )
    return lines, ["_file", "_start", "_line"]


def url_list(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """``value`` of each line, stripped; the first ``limit`` by file name and line if given."""
    lines, order = _lines_in_order(spark, path)
    return (lines.orderBy(*order).limit(limit) if limit is not None else lines).select("value")


def json_lines(spark: SparkSession, path: str, schema: T.StructType = RAW_HTML) -> DataFrame:
    """One object a line; a line that is none fails the read."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def parquet(spark: SparkSession, path: str, skip_corrupt: bool = False, lineage: str | None = None, pattern: str | None = None) -> DataFrame:
    """Parquet files; unreadable ones are left out if asked, ``lineage`` names a column for the file of a row."""
    reader = spark.read
    if skip_corrupt:
        reader = reader.option("ignoreCorruptFiles", "true").option("mergeSchema", "true")  # a corrupt file mustn't be the one that gives the schema
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    df = reader.parquet(path)
    return df.withColumn(lineage, F.col("_metadata.file_path")) if lineage else df


def with_order(df: DataFrame, out: str = "ord") -> DataFrame:
    """A total order of a Parquet read: file name, then row within the file."""
    return df.withColumn(out, F.struct(F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row")))


def with_number(df: DataFrame, out: str = "ord") -> DataFrame:
    """The same order of a Parquet read as one BIGINT: the file's place by name, and the row within the file (up to 2**40).

    The driver sorts the list of files; a long one isn't broadcast but meets
    the rows by a shuffle, in which no key has more rows than a file.
    """
    names = [r["_path"] for r in df.select(F.col("_metadata.file_path").alias("_path")).distinct().collect()]
    names.sort(key=lambda p: (p.rsplit("/", 1)[1], p))
    places = df.sparkSession.createDataFrame([(p, i) for i, p in enumerate(names)], "_path STRING, _place BIGINT")
    numbered = df.withColumn("_path", F.col("_metadata.file_path")).withColumn("_row", F.col("_metadata.row_index"))
    return numbered.join(places, "_path").withColumn(out, F.shiftleft(F.col("_place"), 40) + F.col("_row")).drop("_path", "_place", "_row")


def word_list(spark: SparkSession, path: str, keep_empty: bool = False) -> list[str]:
    """Listed words in order of files and lines, stripped, empty ones left out unless kept; for lists that fit the driver."""
    lines, order = _lines_in_order(spark, path)
    return [w for w in (r["value"].strip() for r in lines.orderBy(*order).select("value").collect()) if w or keep_empty]


def domain_list(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``domain``: distinct non-empty lines of category files, stripped."""
    return spark.read.text(paths).select(strip("value").alias("domain")).filter("domain <> ''").distinct()


def concept_thresholds(spark: SparkSession, path: str) -> DataFrame:
    """``section, concept, threshold`` of a two-level ``name: number`` file."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\n")).alias("line_no", "line"))
    rows = [(r["line_no"], r["line"]) for r in lines.collect()]
    out, section = [], None
    for _, line in sorted(rows):
        name, _, value = line.split("#")[0].partition(":")
        name, value = name.strip().strip("\"'-").strip(), value.strip()
        if name and not value:
            section = name
        elif name:
            try:
                out.append((section, name, float(value)))
            except ValueError:
                pass
    return spark.createDataFrame(out, "section STRING, concept STRING, threshold DOUBLE")


Fetch = Callable[[str], bytes]


def fetch_images(pairs: DataFrame, fetch: Fetch, resize: Callable[[bytes], tuple[bytes, int, int]] | None = None, url: str = "url", threads: int = 32) -> DataFrame:
    """``pairs`` with ``jpg, status, original_width, original_height``, fetched by ``threads`` a task.

    ``fetch`` gives an address's bytes or raises; ``resize`` gives new bytes
    and the original size.  Failures have the status ``failed_to_download`` or
    ``failed_to_resize`` and null bytes; a null address fails likewise.
    Repartition before to set how many tasks fetch at once.
    """
    given = ("jpg", "status", "original_width", "original_height")
    carried = [c for c in pairs.columns if c not in given]

    def one(address: str | None) -> tuple:
        try:
            if address is None:
                raise ValueError("no address")
            data = fetch(address)
        except Exception:
            return None, "failed_to_download", None, None
        try:
            data, width, height = resize(data) if resize else (data, None, None)
        except Exception:
            return None, "failed_to_resize", None, None
        return data, "success", width, height

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from concurrent.futures import ThreadPoolExecutor

        with ThreadPoolExecutor(threads) as pool:
            for batch in batches:
                for at in range(0, batch.num_rows, 1000):
                    part = batch.slice(at, 1000)
                    found = list(pool.map(one, part.column(carried.index(url)).to_pylist()))
                    kinds = (pa.binary(), pa.string(), pa.int32(), pa.int32())
                    columns = [pa.array([f[i] for f in found], k) for i, k in enumerate(kinds)]
                    yield pa.RecordBatch.from_arrays([*part.columns, *columns], [*carried, *given])

    schema = T.StructType([*(pairs.schema[c] for c in carried), *struct("jpg BINARY, status STRING, original_width INT, original_height INT").fields])
    return pairs.select(*carried).mapInArrow(run, schema)


def first_files(spark: SparkSession, pattern: str, n: int) -> list[str]:
    """The first ``n`` files of a glob by name."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(conf).globStatus(path) or []
    return sorted(f.getPath().toString() for f in found if f.isFile())[:n]


def npy_vectors(spark: SparkSession, path: str) -> DataFrame:
    """``file, row, vector`` of two-dimensional ``.npy`` arrays; one file is one task's."""
    import io

    import numpy as np

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                array = np.load(io.BytesIO(data), allow_pickle=False)
                for at in range(0, len(array), 10_000):
                    part = np.ascontiguousarray(array[at : at + 10_000], np.float32)
                    lists = pa.ListArray.from_arrays(np.arange(len(part) + 1, dtype=np.int32) * part.shape[1], pa.array(part.ravel()))
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(part)), pa.array(np.arange(at, at + len(part))), lists], ["file", "row", "vector"])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, "file string, row bigint, vector array<float>")


def newline_counts(spark: SparkSession, paths: list[str], chunk: int = 1 << 20) -> DataFrame:
    """``file, n``: newline bytes of each file, read in chunks, so an unterminated last line isn't counted.

    Files that can't be read count 0.  Paths may be of any storage that
    :func:`millrace.sources.warc.open_file` opens, and must be open to every executor.
    """
    from millrace.sources.warc import open_file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = []
            for path in batch.column(0).to_pylist():
                n = 0
                try:
                    with open_file(path) as f:
                        while part := f.read(chunk):
                            n += part.count(b"\n")
                except OSError:
                    n = 0
                counts.append(n)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], ["file", "n"])

    return spark.createDataFrame([(p,) for p in paths], "file string").repartition(max(1, len(paths))).mapInArrow(run, "file string, n bigint")
