import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from millrace.llm.capping import _cut_off, cap_contributors, cut_by_cap, water_level


def brute_level(sizes, share):
    best = 0
    for c in range(1, max(sizes, default=0) + 1):
        if c <= share * sum(min(n, c) for n in sizes) + 1e-9:
            best = c
    return best


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=12), st.sampled_from([0.05, 0.1, 0.2, 0.25, 0.34, 0.5, 0.9, 1.0]))
def test_water_level_is_the_largest_consistent_one(sizes, share):
    counts = [(n, sizes.count(n)) for n in set(sizes)]
    assert water_level(counts, share) == brute_level(sizes, share)


SCHEMA = "id bigint, who string, q double"


def test_caps_with_ties_nulls_and_nan(spark):
    nan = float("nan")
    rows = [(i, "a", 0.5) for i in range(8)] + [(20, "a", 0.9), (21, "a", None), (22, "a", nan), (30, "b", 0.1), (31, None, 0.2), (32, None, 0.1)]
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA + ", n int")
    kept = {r.id for r in cap_contributors(df, ["who"], "q", "id", max_count=3).collect()}
    assert kept == {20, 0, 1, 30, 31, 32}
    assert {r.id for r in cut_by_cap(df, ["who"], "q", "id", max_count=10).collect()} == {22}
    nameless = df.unionByName(spark.createDataFrame([(None, "a", 0.0, 1)], SCHEMA + ", n int"))
    assert {r.id for r in cut_by_cap(nameless, ["who"], "q", "id", max_count=10).collect()} == {22}
    assert cap_contributors(df, ["who"], "q", "id").count() == len(rows)
    assert cap_contributors(df, ["who"], "q", "id", max_share=0.4).count() == sum(min(n, brute_level([11, 1, 2], 0.4)) for n in (11, 1, 2))
    assert cap_contributors(df.limit(0), ["who"], "q", "id", max_share=0.4).count() == 0
    with pytest.raises(ValueError):
        cap_contributors(df, ["who"], "q", "id", max_share=0.05)


def test_a_dominant_contributor_is_cut_without_a_window_over_it(spark):
    random = np.random.default_rng(2)
    who = np.where(random.random(6000) < 0.4, "big", np.char.add("w", random.integers(0, 40, 6000).astype(str)))
    rows = [(i, None if w == "w7" else str(w), None if i % 97 == 0 else float("nan") if i % 89 == 0 else float(random.integers(0, 50)), str(i % 3)) for i, w in enumerate(who)]
    df = spark.createDataFrame(rows, SCHEMA + ", _before string").repartition(7)
    for level in (1, 60, 1500):
        want = set()
        for w in {r[1] for r in rows}:
            own = sorted((r for r in rows if r[1] == w), key=lambda r: (-(r[2] if r[2] is not None and r[2] == r[2] else -1.0), r[0]))
            want |= {r[0] for r in own[:level]}
        kept = _cut_off(df, ["who"], F.when(F.isnan("q"), None).otherwise(F.col("q")), "id", level)
        assert sorted(r.id for r in kept.collect()) == sorted(want) and kept.columns == df.columns
    plan = kept._jdf.queryExecution().toString()
    # Windows stand over counts by range, and over rows of one range; none over a contributor's rows.
    plan = plan[plan.index("== Physical Plan ==") :]
    windows = re.findall(r"Window \[(.*?) windowspecdefinition\((\w+)#", plan)
    assert windows and all(key.startswith(("range", "key")) for _, key in windows) and all("row_number" not in f for f, key in windows if key.startswith("key"))
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "10")
    try:
        few = cap_contributors(df, ["who"], "q", "id", max_share=0.05)
        sizes = sorted(few.groupBy("who").count().collect(), key=lambda r: -r["count"])
        assert sizes[0]["count"] <= 0.05 * few.count()
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")
