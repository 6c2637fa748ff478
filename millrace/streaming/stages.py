"""The pipeline as streams: new files only, state in checkpoints and tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.dedup import greedy_two_key, key_hashes
from millrace.sources.sinks import has_parts


def stream_stage(
    spark: SparkSession, source: str, schema: T.StructType, transform: Callable[[DataFrame], DataFrame], target: str, checkpoint: str, max_files: int | None = None
) -> StreamingQuery:
    """Runs a stage over the files of ``source`` that came since its last run, and stops.

    The checkpoint knows the files that are done, so a stage that failed half
    way goes on where it was and no file is processed twice.
    """
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return (
        transform(reader.parquet(source))
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def first_seen_stream(df: DataFrame, key: str, event_time: str | None = None, delay: str | None = None) -> DataFrame:
    """A stream's first row of each ``key``; with ``event_time`` and ``delay`` keys are forgotten after the watermark.

    Within one micro-batch which row stays is Spark's choice.
    """
    if event_time and delay:
        return df.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])
    return df.dropDuplicates([key])


def greedy_stream(
    spark: SparkSession, source: str, schema: T.StructType, target: str, seen: str, checkpoint: str, first_key: str = "url", second_key: str = "caption", ord: str = "ord"
) -> StreamingQuery:
    """Two-key greedy deduplication over files as they come; earlier batches go before later ones.

    Each batch passes the batch operator with the keys of the table at
    ``seen`` taken from the start, and its own kept keys are added under the
    batch's number, so a batch run again replaces its own.  A table that is
    there but can't be read fails the batch.
    """
    schema_of_seen = "u BIGINT, c BIGINT, batch INT"

    def each(batch: DataFrame, number: int) -> None:
        before = None
        if has_parts(spark, seen):
            before = spark.read.schema(schema_of_seen).parquet(seen).filter(F.col("batch") != number)
        kept = greedy_two_key(batch, first_key, second_key, ord, before)
        kept.write.mode("overwrite").parquet(f"{target}/batch={number}")
        written = spark.read.schema(batch.schema).parquet(f"{target}/batch={number}")
        key_hashes(written, first_key, second_key).write.mode("overwrite").parquet(f"{seen}/batch={number}")

    return (
        spark.readStream.schema(schema).parquet(source).writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
