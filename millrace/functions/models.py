"""Models brought by the caller, run once per Python worker over Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any, Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.images import Decode, decode_image, resized
from millrace.functions.vectors import HEADS, Head


class Scorer(Protocol):
    """A model over a list of inputs: one result each, in order; None where there is none."""

    def __call__(self, batch: list[Any]) -> list[Any]: ...


def score(make: Callable[[], Scorer], kind: T.DataType, *inputs: Column | str, batch_size: int = 512) -> Column:
    """Column of a model's results over ``inputs`` (tuples where there are several).

    ``make`` builds the model on the worker, once.  Rows with a null or NaN input,
    and rows of a batch the model fails on that it also fails on alone, get
    NULL.  The column is non-deterministic to Spark, so that a filter on it
    doesn't run the model twice; put cheap filters before.
    """

    def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        model = make()

        def each(rows: list[Any]) -> list[Any]:
            try:
                return list(model(rows))
            except Exception:
                if len(rows) == 1:
                    return [None]
                return [x for row in rows for x in each([row])]

        for series in batches:
            rows = list(zip(*(series if isinstance(series, tuple) else (series,))))
            whole = [i for i, r in enumerate(rows) if not any(x is None or (isinstance(x, float) and x != x) for x in r)]
            out: list[Any] = [None] * len(rows)
            for at in range(0, len(whole), batch_size):
                part = whole[at : at + batch_size]
                for i, x in zip(part, each([rows[i] if len(inputs) > 1 else rows[i][0] for i in part])):
                    out[i] = x
            yield pd.Series(out, dtype=object)

    run.__annotations__ = {"batches": Iterator[tuple[pd.Series, ...]], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, kind).asNondeterministic()(*inputs)


def embed(make: Callable[[], Scorer], *inputs: Column | str, batch_size: int = 512) -> Column:
    """Embeddings of texts, images or both as ARRAY<FLOAT>."""
    return score(make, T.ArrayType(T.FloatType()), *inputs, batch_size=batch_size)


def one_line(text: Column | str) -> Column:
    """Line ends as spaces, white space off both ends: how quality classifiers take a text."""
    return F.trim(F.regexp_replace(text, r"[\r\n]", " "))


def head(name: str, weights: list[tuple[np.ndarray, np.ndarray]] | None = None, seed: int = 0) -> Head:
    """The safety head of a backbone: ``B32``, ``L14`` or ``H14``, with the given layers or seeded ones."""
    if name not in HEADS:
        raise ValueError(f"unknown head {name!r}; known are {', '.join(HEADS)}")
    _, sigmoid, tail = HEADS[name]
    return Head(weights, sigmoid, tail) if weights is not None else Head.seeded(name, seed)


def pixels_for_model(data: bytes, mean: tuple[float, ...], deviation: tuple[float, ...], size: int = 224, decode: Decode | None = None) -> np.ndarray | None:
    """Channels x size x size floats: resized without keeping the aspect, normalised per channel; None for unreadable bytes."""
    pixels = decode_image(data, decode)
    if pixels is None:
        return None
    scaled = resized(pixels, size, size).astype(np.float32) / 255
    return ((scaled - np.array(mean, np.float32)) / np.array(deviation, np.float32)).transpose(2, 0, 1)


def train_head(df: DataFrame, vector: str, label: str, hidden: tuple[int, ...] = (32, 32), rounds: int = 100, seed: int = 1):
    """A feed-forward classifier over L2-normalised vectors, fitted by Spark on all rows; ``label`` is 0 or 1.

    Returns the fitted model; its ``transform`` adds ``prediction`` and
    ``probability`` to a frame prepared by :func:`vector_features`.
    """
    from pyspark.ml.classification import MultilayerPerceptronClassifier

    ready = vector_features(df.filter(F.col(vector).isNotNull() & F.col(label).isNotNull()), vector).withColumn("label", F.col(label).cast("double"))
    width = ready.select(F.size(vector)).first()[0]
    return MultilayerPerceptronClassifier(layers=[width, *hidden, 2], maxIter=rounds, seed=seed).fit(ready.select("features", "label"))


def vector_features(df: DataFrame, vector: str) -> DataFrame:
    """``df`` with ``features``, the normalised vector as Spark's ML expects it."""
    from pyspark.ml.functions import array_to_vector

    from millrace.functions.vectors import l2_normalise

    return df.withColumn("features", array_to_vector(l2_normalise(vector)))


def mean_of_batch_means(losses: DataFrame, loss: str, batch: str) -> DataFrame:
    """``mean_loss`` as a training loop reports it: the mean of the batches' means."""
    return losses.groupBy(batch).agg(F.avg(loss).alias("_mean")).agg(F.avg("_mean").alias("mean_loss"))
