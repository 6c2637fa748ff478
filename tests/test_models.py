import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import models
from millrace.functions.vectors import Head
from millrace.sources import readers, sinks


def test_score_isolates_failures(spark):
    def length_model():
        def run(batch):
            if any(x == "bad" for x in batch):
                raise ValueError("bad")
            return [float(len(x)) for x in batch]

        return run

    df = spark.createDataFrame([(1, "a"), (2, "bad"), (3, None), (4, "cccc"), (5, "")], "i int, t string")
    got = {r.i: r.s for r in df.select("i", models.score(length_model, T.DoubleType(), "t", batch_size=4).alias("s")).collect()}
    assert got == {1: 1.0, 2: None, 3: None, 4: 4.0, 5: 0.0}
    both = df.select("i", models.score(lambda: lambda rows: [a + len(b) for a, b in rows], T.IntegerType(), "i", "t").alias("s"))
    assert {r.i: r.s for r in both.collect()}[4] == 8
    vectors = df.select("i", models.embed(lambda: lambda ts: [[float(len(t)), 1.0] for t in ts], "t").alias("v")).collect()
    assert vectors[3].v == [4.0, 1.0] and vectors[2].v is None
    assert df.select(models.one_line(F.lit(" a\r\nb\n")).alias("x")).first().x == "a  b"


def test_heads_and_pixels():
    assert isinstance(models.head("B32"), Head)
    with pytest.raises(ValueError):
        models.head("none")
    data = b"P6\n2 2\n255\n" + bytes([255] * 12)
    out = models.pixels_for_model(data, (0.5, 0.5, 0.5), (0.5, 0.5, 0.5), 4)
    assert out.shape == (3, 4, 4) and np.allclose(out, 1) and models.pixels_for_model(b"x", (0,), (1,)) is None


def test_train_head(spark):
    r = np.random.default_rng(0)
    rows = [((r.normal(size=4) + (2 if y else -2)).tolist(), y) for y in (0, 1) for _ in range(100)] + [(None, 1)]
    df = spark.createDataFrame(rows, "v array<double>, y int")
    model = models.train_head(df, "v", "y", (4,), 50)
    out = model.transform(models.vector_features(df.filter("v IS NOT NULL"), "v"))
    assert out.filter(F.col("prediction") == F.col("y")).count() > 190
    losses = spark.createDataFrame([(1, 1.0), (1, 3.0), (2, 5.0)], "b int, x double")
    assert models.mean_of_batch_means(losses, "x", "b").first().mean_loss == 3.5


def test_files(spark, tmp_path):
    np.save(tmp_path / "a.npy", np.arange(6, dtype=np.float64).reshape(3, 2))
    got = readers.npy_vectors(spark, str(tmp_path / "*.npy")).orderBy("row").collect()
    assert [r.vector for r in got] == [[0, 1], [2, 3], [4, 5]]
    (tmp_path / "b.jsonl").write_bytes(b"{}\n{}")
    (tmp_path / "c.jsonl").write_bytes(b"")
    paths = readers.first_files(spark, f"{tmp_path}/*.jsonl", 2)
    assert [p.rsplit("/", 1)[1] for p in paths] == ["b.jsonl", "c.jsonl"] and len(readers.first_files(spark, f"{tmp_path}/*.jsonl", 1)) == 1
    counts = readers.newline_counts(spark, [str(tmp_path / "b.jsonl"), str(tmp_path / "c.jsonl"), str(tmp_path / "gone")]).collect()
    assert {r.file.rsplit("/", 1)[1]: r.n for r in counts} == {"b.jsonl": 1, "c.jsonl": 0, "gone": 0}
    df, seen = sinks.observed(spark.range(5), "kept", top=F.max("id"))
    df.count()
    assert seen.get == {"rows": 5, "top": 4}
