"""Vector expressions and the heads that score embeddings."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _wide(v: Column | str) -> Column:
    """Elements as DOUBLE, before any arithmetic."""
    return (F.col(v) if isinstance(v, str) else v).cast("array<double>")


def dot(a: Column | str, b: Column | str) -> Column:
    return F.aggregate(F.zip_with(_wide(a), _wide(b), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(v: Column | str) -> Column:
    return F.sqrt(F.aggregate(_wide(v), F.lit(0.0), lambda s, x: s + x * x))


def cosine(a: Column | str, b: Column | str, floor: float = 1e-8) -> Column:
    """Cosine with both norms floored; NULL for NULL or for vectors of different lengths."""
    value = dot(a, b) / (F.greatest(norm(a), F.lit(floor)) * F.greatest(norm(b), F.lit(floor)))
    return F.when(F.size(_wide(a)) == F.size(_wide(b)), value)


def _bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once a row, not once for each element a lambda within it visits."""
    return F.element_at(F.transform(F.array(value), use), 1)


def l2_normalise(v: Column | str) -> Column:
    """v over its norm; the zero vector stays as it is."""
    return _bound(F.coalesce(F.nullif(norm(v), F.lit(0.0)), F.lit(1.0)), lambda n: F.transform(_wide(v), lambda x: x / n))


def standardise(v: Column | str, mean: Column, variance: Column, eps: float = 1e-10) -> Column:
    """(v - mean) / (sqrt(variance) + eps), element by element."""
    centred = F.zip_with(_wide(v), _wide(mean), lambda x, m: x - m)
    return F.zip_with(centred, _wide(variance), lambda x, s: x / (F.sqrt(s) + eps))


def dimension_moments(df: DataFrame, vector: str) -> DataFrame:
    """``dim, mean, variance, n``: population moments of each dimension."""
    return (
        df.select(F.posexplode(_wide(vector)).alias("dim", "x"))
        .groupBy("dim")
        .agg(F.avg("x").alias("mean"), F.var_pop("x").alias("variance"), F.count("x").alias("n"))
    )


def binary_cross_entropy(target: Column, p: Column, eps: float = 1e-10) -> Column:
    """Mean of -(t log2(p + eps) + (1 - t) log2(1 - p + eps)) over the rows."""
    return F.avg(-(target * F.log2(p + eps) + (1 - target) * F.log2(1 - p + eps)))


def sign_bits_hex(values: Column) -> Column:
    """Hex of the bits "above the median", four a digit, of an array of DOUBLE whose length is a multiple of four."""
    half = (F.size(values) / 2).cast("int")

    def digits(bits: Column) -> Column:
        digit = lambda i: F.lower(F.hex(F.aggregate(F.slice(bits, i * 4 + 1, 4), F.lit(0), lambda s, b: s * 2 + b)))
        return F.array_join(F.transform(F.sequence(F.lit(0), (F.size(bits) / 4).cast("int") - 1), digit), "")

    median = lambda ordered: (F.element_at(ordered, half) + F.element_at(ordered, half + 1)) / 2
    above = lambda m: F.transform(values, lambda x: (x > m).cast("int"))
    return _bound(F.array_sort(values), lambda ordered: _bound(median(ordered), lambda m: _bound(above(m), digits)))


def label_score(labels: Column, probabilities: Column) -> Column:
    """Sum of each label's last digit times its probability."""
    return F.aggregate(
        F.zip_with(labels, probabilities, lambda name, p: F.substring(name, -1, 1).cast("int") * p), F.lit(0.0), lambda s, x: s + x
    )


def positive_probability(top_label: Column, p: Column, positive: str = "__label__pos") -> Column:
    """The top probability if the top label is the positive one, else what is left of 1."""
    return F.when(top_label == positive, p).otherwise(1 - p)


#: Layer sizes of the safety heads, whether the outputs pass a sigmoid, and how many last layers have no ReLU between.
HEADS = {
    "B32": ((512, 32, 32, 1), True, 1),
    "L14": ((768, 64, 512, 256, 1), True, 1),
    "H14": ((1024, 1024, 2048, 1024, 256, 128, 16, 1), False, 2),
}


class Head:
    """A feed-forward head over embeddings; dropout is the identity here."""

    def __init__(self, layers: list[tuple[np.ndarray, np.ndarray]], sigmoid: bool, linear_tail: int = 1, mean: np.ndarray | None = None, variance: np.ndarray | None = None):
        self.layers, self.sigmoid, self.linear_tail = layers, sigmoid, linear_tail
        self.mean, self.variance = mean, variance

    @classmethod
    def seeded(cls, name: str, seed: int = 0, width: int | None = None) -> Head:
        """A head of a known shape with reproducible weights, for use without trained ones."""
        sizes, sigmoid, tail = HEADS[name]
        sizes = (width or sizes[0], *sizes[1:])
        random = np.random.default_rng(seed)
        layers = [(random.normal(0, 1 / np.sqrt(a), (a, b)), random.normal(0, 0.1, b)) for a, b in zip(sizes, sizes[1:])]
        return cls(layers, sigmoid, tail)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        if self.mean is not None and self.variance is not None:
            x = (x - self.mean) / (np.sqrt(self.variance) + 1e-10)
        last = len(self.layers)
        for i, (w, b) in enumerate(self.layers, 1):
            x = x @ w + b
            if i <= last - self.linear_tail:
                x = np.maximum(x, 0)
        x = x[:, 0]
        return 1 / (1 + np.exp(-x)) if self.sigmoid else x


def head_score(vector: Column | str, head: Head, normalise: bool = True) -> Column:
    """DOUBLE score of each vector, in Arrow batches; NULL for NULL and for vectors of another length.

    The weights travel with the function; the column is marked
    non-deterministic so that a filter on it doesn't run the head twice.
    """

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        size = head.layers[0][0].shape[0]
        for batch in batches:
            fit = np.array([v is not None and len(v) == size for v in batch], bool)
            out = np.full(len(batch), np.nan)
            if fit.any():
                x = np.stack([np.asarray(v, np.float64) for v, ok in zip(batch, fit) if ok])
                if normalise:
                    x = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
                out[fit] = head(x)
            yield pd.Series(np.where(fit, out, None), dtype=object).astype("Float64")

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, T.DoubleType()).asNondeterministic()(vector)
