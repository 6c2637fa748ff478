"""Ordered deduplication.

``ord`` is a column of unique values that gives the rows their order, such as
an id or ``struct(file_name, row_index)``; never a number made after a shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.plans.lineage import discard, materialise
from millrace.plans.skew import HOT_SLICES


def first_seen(df: DataFrame, key: str, ord: str) -> DataFrame:
    """The first row of each value of ``key`` by ``ord``; a null key is a value like any other.

    Only key and order are shuffled, summed up before the shuffle; the rows
    themselves follow by a join on the order, which no value can skew.
    """
    first = df.groupBy(F.xxhash64(key).alias("_h"), F.col(key)).agg(F.min(ord).alias("_first")).select("_first")
    return df.join(first, df[ord] == first["_first"], "left_semi")


def _drop_settled(rows: DataFrame, state: DataFrame, key: str, limit: int) -> DataFrame:
    """Rows whose ``key`` isn't settled.  ``state``: ``key, n, settled``, unique by key.

    Keys of ``limit`` rows or more are broadcast (there can be but HOT_SLICES
    of them) and their rows hashed by row for the join of the others.
    """
    hot = F.broadcast(state.filter(F.col("n") >= limit).select(F.col(key).alias("_hot"), F.col("settled").alias("_hot_settled")))
    cold = state.filter((F.col("n") < limit) & F.col("settled")).select(F.col(key).alias("_cold"), F.lit(False).alias("_cold_is_hot"))
    marked = rows.join(hot, F.col(key) == F.col("_hot"), "left").filter(~F.coalesce("_hot_settled", F.lit(False)))
    marked = marked.withColumn("_is_hot", F.col("_hot").isNotNull()).withColumn("_meet", F.when(F.col("_is_hot"), F.xxhash64("ord")).otherwise(F.col(key)))
    return marked.join(cold, (F.col("_meet") == F.col("_cold")) & (F.col("_is_hot") == F.col("_cold_is_hot")), "left_anti").select(*rows.columns)


#: Rows left that one task finishes in order, and rounds before that is tried.
RESIDUE_ROWS, PARALLEL_ROUNDS = 200_000, 12


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    urls: set[int] = set()
    captions: set[int] = set()
    for batch in batches:
        kept = []
        for ord, u, c in zip(*(x.to_pylist() for x in batch.columns)):
            if u not in urls and c not in captions:
                urls.add(u)
                captions.add(c)
                kept.append(ord)
        yield pa.RecordBatch.from_arrays([pa.array(kept, pa.int64())], ["ord"])


def _without_settled(rows: DataFrame, before: DataFrame) -> DataFrame:
    """``ord, u, c`` of rows neither of whose keys is among the hashes ``u, c`` of ``before``."""
    limit = max(2, math.ceil(rows.count() / HOT_SLICES))
    for key in ("u", "c"):
        earlier = before.select(F.col(key).alias("_earlier")).distinct()
        state = rows.groupBy(key).agg(F.count("*").alias("n")).join(earlier, F.col(key) == F.col("_earlier"), "left")
        rows = _drop_settled(rows, state.select(key, "n", F.col("_earlier").isNotNull().alias("settled")), key, limit)
    return rows


def key_hashes(df: DataFrame, first_key: str, second_key: str) -> DataFrame:
    """``u, c``: the hashes by which :func:`greedy_two_key` compares keys."""
    return df.select(F.xxhash64(first_key).alias("u"), F.xxhash64(F.lit(1), second_key).alias("c"))


def greedy_two_key(df: DataFrame, first_key: str = "url", second_key: str = "caption", ord: str = "ord", before: DataFrame | None = None) -> DataFrame:
    """Rows a pass in order keeps: a row stays if neither key occurred in a row that stayed; others register nothing.

    The lexicographically first maximal matching of the two keys, found in
    parallel rounds (Blelloch, Fineman and Shun, SPAA 2012): each round keeps
    the rows that are first among the open rows for both keys and drops all
    rows that share a key with them.  The rounds needed grow with the
    logarithm of the rows in usual orders; what a long chain leaves after
    PARALLEL_ROUNDS is finished in order by one task once it is small enough,
    and goes on in rounds until then: the result is whole however long the
    chain.  A round's table of open rows is removed with the next one's.

    ``ord`` must be a unique integer.  Rows with a null key are dropped; keys
    are compared by 64-bit hashes of their values.  ``before`` has the hashes
    (see :func:`key_hashes`) of keys that count as taken from the start.
    """
    rows = (
        df.filter(F.col(first_key).isNotNull() & F.col(second_key).isNotNull())
        .select(F.xxhash64(first_key).alias("u"), F.xxhash64(F.lit(1), second_key).alias("c"), F.col(ord).cast("bigint").alias("ord"))
        # Of equal rows only the first can stay, and it settles both keys or is dropped with them.
        .groupBy("u", "c").agg(F.min("ord").alias("ord")).select("ord", "u", "c")
    )
    rows = materialise(rows, "open")
    if before is not None:
        rows = materialise(_without_settled(whole := rows, before), "open")
        discard(whole)
    parts: list[DataFrame] = []
    turn = 0
    while left := rows.count():
        if turn >= PARALLEL_ROUNDS and left <= RESIDUE_ROWS:
            parts.append(materialise(rows.coalesce(1).sortWithinPartitions("ord").mapInArrow(_in_order, "ord bigint"), "rest"))
            discard(rows)
            break
        turn += 1
        limit = max(2, math.ceil(left / HOT_SLICES))
        by_u = rows.groupBy("u").agg(F.min("ord").alias("ord"), F.count("*").alias("n"))
        by_c = rows.groupBy("c").agg(F.min("ord").alias("ord"), F.count("*").alias("n"))
        now = materialise(by_u.select("ord", "u").join(by_c.select("ord", "c"), "ord").select("ord"), "kept")
        parts.append(now)
        flags = now.select(F.col("ord").alias("_kept"))
        state_u = by_u.join(flags, F.col("ord") == F.col("_kept"), "left").select("u", "n", F.col("_kept").isNotNull().alias("settled"))
        state_c = by_c.join(flags, F.col("ord") == F.col("_kept"), "left").select("c", "n", F.col("_kept").isNotNull().alias("settled"))
        after = materialise(_drop_settled(_drop_settled(rows, state_u, "u", limit), state_c, "c", limit), "open")
        discard(rows)
        rows = after
        if len(parts) >= 50:  # a long chain's many small tables become one
            whole = materialise(reduce(DataFrame.unionByName, parts).coalesce(8), "kept")
            for part in parts:
                discard(part)
            parts = [whole]
    if not parts:
        return df.limit(0)
    kept = reduce(DataFrame.unionByName, parts).select(F.col("ord").alias("_kept_ord"))
    return df.join(kept, df[ord].cast("bigint") == kept["_kept_ord"], "left_semi")


class BloomFilter:
    """Bits for ``capacity`` elements at ``error`` false positives; all operations on arrays of 64-bit hashes."""

    def __init__(self, capacity: int, error: float):
        self.bits = max(64, math.ceil(-capacity * math.log(error) / math.log(2) ** 2))
        self.hashes = max(1, round(self.bits / max(capacity, 1) * math.log(2)))
        self.words = np.zeros(-(-self.bits // 8), np.uint8)

    def _places(self, h: np.ndarray) -> np.ndarray:
        h = h.astype(np.int64).view(np.uint64)
        step = ((h >> np.uint64(33)) | np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        return (h[:, None] + step[:, None] * np.arange(self.hashes, dtype=np.uint64)) % np.uint64(self.bits)

    def contains(self, h: np.ndarray) -> np.ndarray:
        at = self._places(h)
        return (self.words[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).all(1)

    def add(self, h: np.ndarray) -> None:
        at = self._places(h).ravel()
        np.bitwise_or.at(self.words, at >> np.uint64(3), (1 << (at & np.uint64(7))).astype(np.uint8))


def first_seen_bloom(df: DataFrame, key: str, ord: str, capacity: int = 50_000_000, error: float = 0.01, partitions: int | None = None) -> DataFrame:
    """Like :func:`first_seen`, but with memory bounded by Bloom filters: a subset of its rows.

    Keys are spread by hash, each partition has a filter for its part of
    ``capacity``.  A false positive drops a first row, in about ``error`` of
    the keys.  Of each map task's rows only the first per key are shuffled.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bloom = BloomFilter(max(1, -(-capacity // n)), error)
        for batch in batches:
            h = batch.column("h").to_numpy()
            _, first = np.unique(h, return_index=True)
            first.sort()
            new = first[~bloom.contains(h[first])]
            bloom.add(h[new])
            yield batch.select(["ord"]).take(pa.array(new))

    keys = df.select(F.xxhash64(key).alias("h"), F.col(ord).cast("bigint").alias("ord")).groupBy("h").agg(F.min("ord").alias("ord"))
    kept = keys.repartition(n, "h").sortWithinPartitions("ord").mapInArrow(run, "ord bigint")
    kept = kept.withColumnRenamed("ord", "_kept_ord")
    return df.join(kept, df[ord].cast("bigint") == kept["_kept_ord"], "left_semi")
