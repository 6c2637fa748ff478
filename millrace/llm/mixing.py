"""Mixing sources to target weights (problem 9).

Each source's copies per document are one number: its share of the mix's size
over its own size, capped.  The whole part is copied outright; the fractional
parts are rounded by the pivotal method: two documents of a source trade their
fractions at random until one of them is 0 or 1, which keeps the sum exact and
each document's expectation.  Within a partition documents of like size trade
first, so the size follows the sum; the one fraction a source is left with
per partition is combined along a tree of shuffles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.tokens import DEFAULT_VOCABULARY, token_counts
from millrace.plans.lineage import materialise

#: Partitions' residuals that meet in one group of the reduction tree.
FAN_IN = 32
_EPS = 1e-9


def plan_mix(sizes: dict[str, int], targets: dict[str, tuple[float, int]], total: float | None = None) -> dict[str, float]:
    """Copies per document for each source.

    ``sizes`` are tokens by source, ``targets`` share and most repeats.
    Sources without a target, without tokens or with a share of 0 get none;
    the other shares are scaled to sum to 1.  Without ``total`` the mix is as
    large as it can be with all shares exact: the smallest of repeats * size /
    share.  With a ``total`` sources that can't fill their part stay at their
    repeats and the others share the rest by their targets.
    """
    usable = {s: (w, r) for s, (w, r) in targets.items() if w > 0 and r > 0 and sizes.get(s, 0) > 0}
    weight = sum(w for w, _ in usable.values())
    if not usable:
        return {}
    most = {s: r * sizes[s] for s, (_, r) in usable.items()}
    if total is None:
        total = min(most[s] * weight / w for s, (w, _) in usable.items())
    part: dict[str, float] = {}
    open_sources, left = dict(usable), float(total)
    while open_sources:
        weight = sum(w for w, _ in open_sources.values())
        full = [s for s, (w, _) in open_sources.items() if left * w / weight >= most[s]]
        if not full:
            part |= {s: left * w / weight for s, (w, _) in open_sources.items()}
            break
        for s in full:
            part[s] = most[s]
            del open_sources[s]
        left = max(0.0, total - sum(part.values()))
    return {s: min(part[s] / sizes[s], usable[s][1]) for s in part}


def _uniform(ids: np.ndarray, salt: int) -> np.ndarray:
    """Reproducible numbers in [0, 1) from ids; the same after a task is run again."""
    x = (ids.astype(np.int64).view(np.uint64) ^ np.uint64((salt * 0x9E3779B97F4A7C15) & (2**64 - 1))) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(29)
    return (x >> np.uint64(11)).astype(np.float64) / 2.0**53


def pivotal(p: np.ndarray, ids: np.ndarray, seed: int = 0) -> np.ndarray:
    """Rounds fractions to 0 and 1 by trading between neighbours; at most one stays fractional.

    The sum is kept to rounding error, each expectation exactly.  Ties and
    repeated ids are no trouble; an empty array gives an empty one.
    """
    p = p.astype(np.float64).copy()
    salt = seed
    while True:
        live = np.flatnonzero((p > _EPS) & (p < 1 - _EPS))
        if len(live) < 2:
            break
        salt += 1
        a, b = live[0 : len(live) - 1 : 2], live[1::2]
        total, u = p[a] + p[b], _uniform(ids[a] * 31 + ids[b], salt)
        low = total <= 1
        # total <= 1: one takes all.  total > 1: one is filled to 1, the other keeps the rest.
        first_wins = np.where(low, u * total < p[a], u * (2 - total) < 1 - p[b])
        big = np.where(low, total, 1.0)
        small = np.where(low, 0.0, total - 1.0)
        p[a], p[b] = np.where(first_wins, big, small), np.where(first_wins, small, big)
    return np.where(p >= 1 - _EPS, 1.0, np.where(p <= _EPS, 0.0, p))


_ROUNDED = "row_id bigint, source string, n_tokens bigint, copies int, rest double, node bigint"


def _round_partition(rates: dict[str, float], seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        node = TaskContext.get().partitionId()
        waiting: dict[str, tuple[int, int, int, float]] = {}  # the one fractional document of a source
        names = [x.split()[0] for x in _ROUNDED.split(", ")]

        def batch_of(row, source, n_tokens, copies, rest) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(row, pa.int64()), pa.array(source, pa.string()), pa.array(n_tokens, pa.int64()), pa.array(copies, pa.int32()), pa.array(rest, pa.float64()), pa.array(np.full(len(row), node, np.int64))],
                names,
            )

        for batch in batches:
            frame = batch.to_pandas()
            for source, rows in frame.groupby("source", sort=True):
                rate = rates.get(source, 0.0)
                whole, fraction = int(rate + _EPS), max(0.0, rate - int(rate + _EPS))
                rows = rows.sort_values(["n_tokens", "row_id"])
                ids, tokens = rows["row_id"].to_numpy(np.int64), rows["n_tokens"].to_numpy(np.int64)
                copies, p = np.full(len(ids), whole, np.int32), np.full(len(ids), fraction)
                if source in waiting:
                    i, t, c, rest = waiting.pop(source)
                    ids, tokens = np.append(ids, i), np.append(tokens, t)
                    copies, p = np.append(copies, np.int32(c)), np.append(p, rest)
                p = pivotal(p, ids, seed)
                live = np.flatnonzero((p > 0) & (p < 1))
                copies = copies + (p == 1).astype(np.int32)
                done = np.ones(len(ids), bool)
                for k in live:
                    waiting[source] = (int(ids[k]), int(tokens[k]), int(copies[k]), float(p[k]))
                    done[k] = False
                yield batch_of(ids[done], [source] * int(done.sum()), tokens[done], copies[done], np.zeros(int(done.sum())))
        if waiting:
            yield batch_of([w[0] for w in waiting.values()], list(waiting), [w[1] for w in waiting.values()], [w[2] for w in waiting.values()], [w[3] for w in waiting.values()])

    return run


def _combine(seed: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop(columns="branch").sort_values(["n_tokens", "row_id"])
        p = pivotal(rows["rest"].to_numpy(), rows["row_id"].to_numpy(np.int64), seed)
        return rows.assign(copies=rows["copies"] + (p == 1).astype(np.int32), rest=np.where((p > 0) & (p < 1), p, 0.0), node=rows["node"] // FAN_IN)

    return run


def mix_sources(
    docs: DataFrame,
    targets: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    total: float | None = None,
    seed: int = 17,
    vocabulary: str = DEFAULT_VOCABULARY,
) -> tuple[DataFrame, DataFrame]:
    """The mix, ``doc_id, source, n_tokens, copies`` with copies > 0, and the shares reached.

    Shares: ``source, target_share, max_repeats, n_docs, n_tokens, copies,
    mix_tokens, share``, one row for each source of either table (null
    source included).  Documents without a source or a target aren't mixed, those with
    a null id not even counted;
    null and empty texts have 0 tokens and are rounded like others.  The
    targets must be unique by source; they are read on the driver (a list of
    sources, not of documents).  The same rows, parted alike, and seed give the same mix.
    """
    sized = materialise(
        token_counts(docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("row_id"), F.col(source_col).alias("source"), text_col), text_col, ["row_id", "source"], vocabulary),
        "sized",
    )
    per_source = sized.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
    wished = targets.select("source", F.col("target_share").cast("double").alias("target_share"), F.col("max_repeats").cast("int").alias("max_repeats"))
    goals = {r["source"]: (r["target_share"] or 0.0, r["max_repeats"] or 0) for r in wished.collect() if r["source"] is not None}
    names = list(goals)
    have = {r["source"]: r["n_tokens"] for r in per_source.filter(F.col("source").isin(names)).collect()} if names else {}
    rates = plan_mix(have, goals, total)

    rounded = materialise(
        sized.filter(F.col("source").isin(list(rates)) if rates else F.lit(False)).mapInArrow(_round_partition(rates, seed), _ROUNDED), "rounded"
    )
    settled = rounded.filter("rest = 0")
    rest = rounded.filter("rest > 0")
    top = rest.agg(F.max("node")).first()[0] or 0
    done: list[DataFrame] = [settled]
    level = seed
    while True:
        level += 1000
        rest = materialise(
            rest.withColumn("branch", F.floor(F.col("node") / FAN_IN)).groupBy("source", "branch").applyInPandas(_combine(level), _ROUNDED),
            "residuals",
        )
        done.append(rest.filter("rest = 0"))
        rest = rest.filter("rest > 0")
        if top == 0:
            break
        top //= FAN_IN
    # One fraction a source is left: its document is drawn by it.
    drawn = F.abs(F.xxhash64(F.lit(seed), "row_id") % 1000003) / 1000003.0
    done.append(rest.withColumn("copies", (F.col("copies") + (drawn < F.col("rest")).cast("int")).cast("int")))
    every = done[0]
    for part in done[1:]:
        every = every.unionByName(part)
    mix = every.filter("copies > 0").select(F.col("row_id").alias(id_col), "source", "n_tokens", "copies")

    taken = mix.groupBy("source").agg(F.sum("copies").alias("copies"), F.sum(F.col("copies") * F.col("n_tokens")).alias("mix_tokens"))
    everything = taken.agg(F.sum("mix_tokens")).first()[0] or 0
    shares = (
        per_source.join(wished.withColumnRenamed("source", "_source"), F.expr("source <=> _source"), "full")
        .withColumn("source", F.coalesce("source", "_source")).drop("_source")
        .join(taken, "source", "left")
        .select(
            "source", "target_share", "max_repeats",
            *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("n_docs", "n_tokens", "copies", "mix_tokens")],
            (F.coalesce("mix_tokens", F.lit(0)) / F.lit(float(max(everything, 1)))).alias("share"),
        )
    )
    return mix, shares
