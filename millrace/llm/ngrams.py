"""Hashed character n-gram counts, gathered over all rows and of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Lengths of n-grams and the bits of their tables' indexes.
ORDER = 5
BITS = 18
START, END = 2, 3
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)


def codes_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts on end, each with ORDER - 1 start marks before and an end mark after;
    and the position of each text's first mark, with the total at the end."""
    pad = chr(START) * (ORDER - 1)
    whole = "".join(f"{pad}{t}{chr(END)}" for t in texts)
    codes = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.array([len(t) + ORDER for t in texts], np.int64)
    return codes, np.append(0, np.cumsum(sizes))


def gram_indexes(codes: np.ndarray, orders: int = ORDER) -> list[np.ndarray]:
    """For n = 1..orders the table index of the n-gram that ends at each position."""
    out, total = [], np.zeros(len(codes), np.uint64)
    wide = codes.astype(np.uint64)
    with np.errstate(over="ignore"):
        for n in range(1, orders + 1):
            shifted = np.zeros(len(codes), np.uint64)
            shifted[n - 1 :] = wide[: len(codes) - n + 1] if n > 1 else wide
            total = (total * np.uint64(31)) ^ (shifted + np.uint64(n)) * _MULTIPLY
            mixed = (total ^ (total >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            # Single characters index themselves; longer grams are hashed.
            out.append((mixed >> np.uint64(64 - BITS) if n > 1 else wide & np.uint64((1 << BITS) - 1)).astype(np.int64))
    return out


def add_counts(counts: np.ndarray, texts: list[str], weight: float = 1.0, orders: int = ORDER) -> None:
    """Adds the texts' n-grams up to ``orders`` to ``counts`` of shape (ORDER, 2**BITS)."""
    if not texts:
        return
    codes, _ = codes_of(texts)
    grams = gram_indexes(codes, orders)
    real = codes != START
    for n in range(orders):
        if n < orders - 1:  # contexts may lie in the start marks
            counts[n] += weight * np.bincount(grams[n], minlength=1 << BITS)
        else:
            counts[n] += weight * np.bincount(grams[n][real], minlength=1 << BITS)


class Counts:
    """A task's sums: n-grams, and ``extra_size`` further numbers that ``extra`` counts of the same texts."""

    def __init__(self, orders: int = ORDER, extra: Callable[[list[str]], np.ndarray] | None = None, extra_size: int = 0):
        self.orders, self.extra = orders, extra
        self.counts, self.more = np.zeros((ORDER, 1 << BITS)), np.zeros(extra_size, np.int64)

    def add(self, texts: list[str]) -> None:
        for at in range(0, len(texts), 5_000):
            part = texts[at : at + 5_000]
            add_counts(self.counts, part, orders=self.orders)
            if self.extra:
                self.more += self.extra(part)

    def cells(self) -> tuple[pa.Array, pa.Array]:
        """The slots that aren't 0, and their numbers."""
        flat = np.concatenate([self.counts.ravel().astype(np.int64), self.more])
        used = np.flatnonzero(flat)
        return pa.array(used.astype(np.int32)), pa.array(flat[used])


def summed(cells: DataFrame, extra_size: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """All tasks' ``slot, n`` together: the n-gram counts and the further numbers; at most ORDER * 2**BITS + ``extra_size`` reach the driver."""
    found = cells.groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros((ORDER << BITS) + extra_size, np.int64)
    counts[found.column("slot").to_numpy()] = found.column("n").to_numpy()
    return counts[: ORDER << BITS].astype(np.float64).reshape(ORDER, 1 << BITS), counts[ORDER << BITS :]


def gather_counts(df: DataFrame, texts_of: Callable[[pa.RecordBatch], list[str]], orders: int = ORDER) -> np.ndarray:
    """N-gram counts over all rows, summed within each task and then by Spark.

    Splits are taken together in as many tasks as the session has cores, twice
    over, so that what is shuffled grows with the cluster and not with the data.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counts(orders)
        for batch in batches:
            counts.add(texts_of(batch))
        yield pa.RecordBatch.from_arrays([*counts.cells()], ["slot", "n"])

    return summed(df.coalesce(coarse(df)).mapInArrow(run, "slot int, n bigint"))[0]


def coarse(df: DataFrame) -> int:
    """Tasks for sums of a bounded size over all rows: two for each core of the session."""
    return 2 * max(1, df.sparkSession.sparkContext.defaultParallelism)


class Model:
    """Interpolated n-gram probabilities from a table of counts."""

    def __init__(self, counts: np.ndarray, strength: float, unseen: float = 1 / 6000, order: int = ORDER):
        self.counts, self.strength, self.unseen, self.order = counts.astype(np.float32), strength, unseen, order
        self.total = float(counts[0].sum()) or 1.0

    def log_probability(self, grams: list[np.ndarray]) -> np.ndarray:
        """Log probability of each position's character after the ``order - 1`` before it."""
        m = self.strength
        p = (self.counts[0][grams[0]] + m * self.unseen) / (self.total + m)
        for n in range(1, self.order):
            context = np.append(0, self.counts[n - 1][grams[n - 1]][:-1])
            both = np.minimum(np.minimum(self.counts[n][grams[n]], context), self.counts[0][grams[0]])  # as collisions allow
            p = (both + m * p) / (context + m)
        return np.log(p)
