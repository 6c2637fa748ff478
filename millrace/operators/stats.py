"""Corpus statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def group_counts(df: DataFrame, key: str | Column, ord: str) -> DataFrame:
    """``key, n, first_ord``: rows and first row of each value; null is a value."""
    value = F.col(key) if isinstance(key, str) else key
    return df.groupBy(value.alias("key")).agg(F.count("*").alias("n"), F.min(ord).alias("first_ord"))


def top_groups(counts: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` largest groups; ties go to the group met first."""
    return counts.orderBy(F.col("n").desc(), F.col("first_ord").asc()).limit(k)


def group_statistics(counts: DataFrame) -> DataFrame:
    """One row: ``n_groups, n_rows, max_n, min_n, mean_n`` (to 2 decimals); NULLs and zeros for no groups."""
    return counts.agg(
        F.count("*").alias("n_groups"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.max("n").alias("max_n"),
        F.min("n").alias("min_n"),
        F.round(F.avg("n"), 2).alias("mean_n"),
    )


def group_histogram(counts: DataFrame, bins: int = 50) -> DataFrame:
    """``bin, n_groups``: equal-width bins from 1 over the groups' sizes, the last closed on both sides; one bin if all sizes are equal."""
    # N rows make at most sqrt(2 N) different sizes, so the bounds are found over few rows.
    sizes = counts.groupBy("n").agg(F.count("*").alias("_groups"))
    all_sizes = W.partitionBy(F.lit(0))
    sizes = sizes.withColumn("_low", F.min("n").over(all_sizes)).withColumn("_high", F.max("n").over(all_sizes))
    width = (F.col("_high") - F.col("_low")) / F.lit(bins)
    number = F.when(F.col("_high") == F.col("_low"), F.lit(1)).otherwise(
        F.least(F.floor((F.col("n") - F.col("_low")) / width) + 1, F.lit(bins))
    )
    return sizes.select(number.cast("int").alias("bin"), "_groups").groupBy("bin").agg(F.sum("_groups").alias("n_groups"))


def rows_per_file(df: DataFrame) -> DataFrame:
    """``file, n`` of a file-based DataFrame."""
    return df.groupBy(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("file")).agg(F.count("*").alias("n"))
