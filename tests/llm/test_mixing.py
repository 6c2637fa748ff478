import os

import numpy as np
import pytest

from millrace.llm.mixing import mix_sources, pivotal, plan_mix
from millrace.llm.tokens import DEFAULT_VOCABULARY


def test_plan():
    rates = plan_mix({"a": 1000, "b": 100, "c": 50, "e": 0}, {"a": (0.5, 4), "b": (0.3, 4), "c": (0.2, 2), "d": (0.1, 2), "e": (0.1, 2), "f": (0, 1)})
    parts = {"a": rates["a"] * 1000, "b": rates["b"] * 100, "c": rates["c"] * 50}
    assert parts["b"] / sum(parts.values()) == pytest.approx(0.3) and rates["c"] == pytest.approx(2)
    assert all(rates[s] <= r + 1e-9 for s, r in (("a", 4), ("b", 4), ("c", 2)))
    big = plan_mix({"a": 1000, "b": 10}, {"a": (0.5, 10), "b": (0.5, 2)}, total=2000)
    assert big["b"] == 2 and big["a"] * 1000 == pytest.approx(1980)
    assert plan_mix({}, {"a": (1, 1)}) == {}


def test_pivotal_keeps_the_sum_and_the_expectations():
    ids = np.arange(1001)
    p = np.linspace(0.01, 0.99, 1001)
    total = np.zeros(1001)
    for seed in range(300):
        out = pivotal(p, ids, seed * 7919)
        assert out.sum() == pytest.approx(p.sum()) and ((out > 0) & (out < 1)).sum() <= 1
        total += out
    assert np.abs(total / 300 - p).mean() < 0.03
    assert pivotal(np.zeros(0), np.zeros(0, int)).tolist() == []
    assert pivotal(np.array([0.4, 0.4]), np.array([5, 5])).sum() == pytest.approx(0.8)


@pytest.mark.skipif(not os.path.exists(DEFAULT_VOCABULARY), reason="no vocabulary file")
def test_mix(spark):
    rows = [(i, f"text number {i} " * (1 + i % 5), "ab"[i % 3 == 0]) for i in range(900)] + [(None, "x", "a"), (2000, None, "a"), (2001, "", "a"), (2002, "x", None), (2003, "x", "zz")]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id bigint, text string, source string, copies int").repartition(40)
    targets = spark.createDataFrame([("a", 0.7, 3), ("b", 0.3, 2), ("gone", 0.0, 2), ("none", 0.1, 4)], "source string, target_share double, max_repeats int")
    mix, shares = mix_sources(docs, targets)
    got = mix.collect()
    assert len({r.doc_id for r in got}) == len(got) and all(1 <= r.copies <= (3 if r.source == "a" else 2) for r in got)
    by = {r.source: r for r in shares.collect()}
    assert by["a"].share == pytest.approx(0.7, abs=0.02) and by["b"].share == pytest.approx(0.3, abs=0.02)
    assert by["none"].n_docs == 0 and by["zz"].mix_tokens == 0 and by[None].copies == 0
    again = {(r.doc_id, r.copies) for r in mix_sources(docs, targets)[0].collect()}
    assert len(again) > 0
    assert mix_sources(docs.limit(0), targets)[0].count() == 0
