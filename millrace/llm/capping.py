"""Capping records per dominant contributor (problem 6)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.plans.lineage import materialise
from millrace.plans.skew import join_hot_aware


def water_level(counts: list[tuple[int, int]], max_share: float) -> int:
    """Largest whole level c with c <= max_share * sum(min(n, c)) over contributors.

    ``counts`` are pairs of a contributor's number of records and how many
    contributors have it.  They are walked from the largest down: while the k
    contributors above a level stand at it and the rest holds ``below``
    records, the level is consistent where c (1 - k max_share) <= max_share * below.
    Where no positive level is consistent (too few contributors for the
    share) the result is 0.
    """
    if max_share >= 1:
        return max((n for n, _ in counts), default=0)
    counts = sorted(counts, reverse=True)
    below, above = sum(n * k for n, k in counts), 0
    for i, (n, k) in enumerate(counts):
        # Level at n or over: only contributors strictly above are cut to it.
        if n <= max_share * (below + above * n) + 1e-9:
            # consistent at n; may rise as long as it stays consistent below the next larger count
            top = counts[i - 1][0] if i else n
            room = 1 - above * max_share
            return top if room <= 0 else max(n, min(top, math.floor(max_share * below / room + 1e-9)))
        below -= n * k
        above += k
    return 0


def count_histogram(df: DataFrame, keys: list[str]) -> list[tuple[int, int]]:
    """How many contributors have how many records.

    N records can have at most sqrt(2 N) different counts (1 + 2 + ... <= N),
    so what reaches the driver is bounded: 1.5 million pairs for 10**12 records.
    """
    sizes = df.groupBy(*keys).agg(F.count("*").alias("_n")).groupBy("_n").agg(F.count("*").alias("_k"))
    return [(r["_n"], r["_k"]) for r in sizes.collect()]


def _ranked(df: DataFrame, contributor: list[str], quality: Column, id_col: str, level: int) -> DataFrame:
    """Each contributor's best rows up to ``level``; Spark cuts row numbers off before the shuffle."""
    rank = F.row_number().over(W.partitionBy(*contributor).orderBy(quality.desc_nulls_last(), F.col(id_col).asc()))
    return df.withColumn("_millrace_rank", rank).filter(F.col("_millrace_rank") <= level).drop("_millrace_rank")


def _cut_off(df: DataFrame, contributor: list[str], quality: Column, id_col: str, level: int) -> DataFrame:
    """The same for levels that no task's rows are cut to: no contributor is sorted in one task.

    Contributors within the level keep all rows.  The others' rows are sorted
    by ranges over all tasks; counts by range and contributor say which ranges
    lie within a contributor's level, and only in the one that holds its
    cut-off rows are numbered.
    """
    key = F.xxhash64(*[x for c in contributor for x in (F.col(c), F.col(c).isNull())])
    who = F.struct(*contributor)
    rows = df.select(F.struct(*df.columns).alias("row"), who.alias("who"), quality.alias("quality"), F.col(id_col).alias("id"), key.alias("key"), F.xxhash64(id_col).alias("spread"))
    sizes = materialise(rows.groupBy("key").agg(F.count("*").alias("n")), "sizes")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    rows = join_hot_aware(rows, sizes, "key", "spread", "n", total)
    order = [F.col("quality").desc_nulls_last(), F.col("id").asc()]
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    over = rows.filter(F.col("n") > level).select("row", "who", "quality", "id", "key").repartitionByRange(ranges, "who", *order)
    over = materialise(over.withColumn("range", F.spark_partition_id()), "ranges")
    counts = over.groupBy("range", "key", "who").agg(F.count("*").alias("own"))
    earlier = W.partitionBy("key", "who").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    counts = counts.select(F.col("range").alias("of_range"), F.col("key").alias("of_key"), F.col("who").alias("of_who"), "own", F.coalesce(F.sum("own").over(earlier), F.lit(0)).alias("before"))
    met = over.join(counts.filter(F.col("before") < level), (F.col("range") == F.col("of_range")) & (F.col("key") == F.col("of_key")) & F.col("who").eqNullSafe(F.col("of_who")))
    whole = met.filter(F.col("before") + F.col("own") <= level)
    rank = F.row_number().over(W.partitionBy("range", "who").orderBy(*order))
    edge = met.filter(F.col("before") + F.col("own") > level).withColumn("rank", rank).filter(F.col("before") + F.col("rank") <= level)
    kept = rows.filter(F.col("n") <= level).select("row").unionByName(whole.select("row")).unionByName(edge.select("row"))
    return kept.select("row.*")


def cap_contributors(
    df: DataFrame,
    contributor: list[str],
    quality: str,
    id_col: str,
    max_count: int | None = None,
    max_share: float | None = None,
) -> DataFrame:
    """The rows of ``df`` that stay: each contributor's best by ``quality``.

    The level is ``max_count``, or the water level of ``max_share`` over all
    contributors, or the smaller of both; ties of quality go to the smaller
    id.  Null and NaN qualities rank last.  A null contributor is a
    contributor like any other.  ``id_col`` must be unique.  A contributor may
    have a third of all rows: up to the level Spark cuts off before a shuffle
    (``spark.sql.optimizer.windowGroupLimitThreshold``) each task sends its
    best only, beyond it rows are sorted by ranges (see :func:`_cut_off`).

    Without a limit ``df`` is returned.  Where too few contributors have rows
    for the share to be kept by any positive level (fewer than
    1 / ``max_share``), ValueError is raised; an empty ``df`` gives an empty result.
    """
    levels = [] if max_count is None else [max_count]
    if max_share is not None:
        counts = count_histogram(df, contributor)
        levels.append(water_level(counts, max_share))
        if counts and not levels[-1]:
            raise ValueError(f"{sum(k for _, k in counts)} contributors are too few for each to have a share of at most {max_share}")
    if not levels:
        return df
    best = F.when(F.isnan(F.col(quality)), F.lit(None)).otherwise(F.col(quality))
    cut_early = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    return (_ranked if min(levels) <= cut_early else _cut_off)(df, contributor, best, id_col, min(levels))


def cut_by_cap(df: DataFrame, contributor: list[str], quality: str, id_col: str, **limits) -> DataFrame:
    """The ids that :func:`cap_contributors` leaves out; rows with a null id take no part."""
    df = df.filter(F.col(id_col).isNotNull())
    kept = cap_contributors(df, contributor, quality, id_col, **limits)
    return df.select(id_col).join(kept.select(id_col), id_col, "left_anti")


def best_scores(clip: DataFrame, pairs: DataFrame) -> DataFrame:
    """``pair_id, snapshot_id, site, score``: pairs with a site and a score.

    The score is a pair's largest similarity that is neither null nor NaN.
    """
    from millrace.functions.urls import site

    scored = (
        clip.filter("similarity IS NOT NULL AND NOT isnan(similarity)")
        .groupBy("pair_id")
        .agg(F.max("similarity").alias("score"))
    )
    taking_part = pairs.select("pair_id", "snapshot_id", site("page_url").alias("site")).filter("site IS NOT NULL")
    return taking_part.join(scored, "pair_id")
