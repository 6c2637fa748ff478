"""Joins on keys of which a few may hold a third of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot when it holds at least 1/HOT_SLICES of the rows, so at most
#: HOT_SLICES keys can be hot: the bound on what is broadcast.
HOT_SLICES = 2000


def join_hot_aware(
    rows: DataFrame,
    table: DataFrame,
    key: str,
    spread: str,
    weight: str,
    total: int,
    slices: int = HOT_SLICES,
    how: str = "inner",
) -> DataFrame:
    """Inner or left join of ``rows`` with ``table`` (one row per ``key``) on a 64-bit ``key``.

    ``weight`` is the column of ``table`` that says how many of the ``total``
    rows have the key; ``spread`` a BIGINT column of ``rows`` that differs from
    row to row.  Hot keys are joined by broadcasting their entries (at most
    ``slices``, as each holds 1/slices of the rows); their rows are then hashed
    by ``spread``, so no task gets a whole hot key.  All other keys meet in an
    ordinary shuffled join.  Rows are scanned and shuffled once.  A null key
    joins nothing; with ``how="left"`` such rows stay, like all others that
    meet no entry, with nulls.
    """
    limit = max(2, -(-total // slices))
    values = [c for c in table.columns if c != key]
    hot = table.filter(F.col(weight) >= limit)
    hot = F.broadcast(hot.select(F.col(key).alias("_hot_key"), F.struct(*values).alias("_hot")))
    cold = table.filter(F.col(weight) < limit).select(
        F.col(key).alias("_cold_key"), F.lit(False).alias("_cold_flag"), F.struct(*values).alias("_cold")
    )
    marked = (
        (rows if how == "left" else rows.filter(F.col(key).isNotNull()))
        .join(hot, F.col(key) == F.col("_hot_key"), "left")
        .withColumn("_is_hot", F.col("_hot").isNotNull())
        .withColumn("_apart", F.col("_is_hot") | F.col(key).isNull())
        .withColumn("_meet", F.when(F.col("_apart"), F.xxhash64(spread)).otherwise(F.col(key)))
    )
    joined = marked.join(
        cold, (F.col("_meet") == F.col("_cold_key")) & (F.col("_apart") == F.col("_cold_flag")), "left"
    ).withColumn("_found", F.coalesce("_hot", "_cold"))
    return (joined if how == "left" else joined.filter(F.col("_found").isNotNull())).select(
        *rows.columns, *[F.col("_found")[c].alias(c) for c in values if c not in rows.columns]
    )
