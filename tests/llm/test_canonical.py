import unicodedata
from collections import defaultdict

import pytest

from millrace.llm.canonical import canonical_text, canonical_url, collapse_records, collision_count, hash_records

SAME = [
    ("https://A.example/x/", "https://a.example/x"),
    ("https://a.example:443/x?b=2&a=1", "https://a.example/x?a=1&b=2"),
    ("http://a.example:80", "http://a.example/"),
    (" https://a.example/x? ", "https://a.example/x"),
    ("https://a.example/x#", "https://a.example/x"),
    ("https://a.example/x?a=1&", "https://a.example/x?a=1"),
]
OTHER = [("https://a.example:80/x", "https://a.example/x"), ("https://a.example/x#y", "https://a.example/x"), ("https://a.example/x?a=1", "https://a.example/x?a=2"), ("http://a.example/", "https://a.example/")]


@pytest.mark.parametrize(("a", "b"), SAME)
def test_urls_that_are_one(a, b):
    assert canonical_url(a) == canonical_url(b)


@pytest.mark.parametrize(("a", "b"), OTHER)
def test_urls_that_differ(a, b):
    assert canonical_url(a) != canonical_url(b)


def test_texts():
    assert canonical_text("「麦畑、テツ​ニ」 ＡＢＣ！") == canonical_text("麦畑テツニabc") == "麦畑テツニabc"
    assert canonical_text("ﾃﾇﾁﾇ") == "テヌチヌ" and canonical_text("。、") == ""


def test_groups_against_brute_force_with_hot_group(spark):
    rows = [(i, ["Ａ b", "a-b", "AB", f"x{i % 40}", "hot！"][i % 5], ["http://h/1", "http://h/1/", "HTTP://H:80/1"][i % 3] if i % 5 else f"http://h/{i % 7}") for i in range(600)]
    rows += [(None, "hot", "http://h/1"), (700, None, "http://h"), (701, "", "http://h"), (702, "a", None), (703, "。", "http://h"), (704, "、", "http://h"), (705, "z" * 40000, "u"), (706, "Z" * 40000, "u")]
    groups = defaultdict(list)
    for i, c, u in rows:
        if c and u and i is not None:
            groups[canonical_text(c), canonical_url(u)].append(i)
    want = {(min(g), i) for g in groups.values() for i in g if i != min(g)}
    df = spark.createDataFrame([(*r, 0) for r in rows], "pair_id bigint, caption string, url string, h1 int").repartition(4)
    got_groups, members = collapse_records(df, "pair_id", ["caption"], ["url"])
    found = [(r.keep_id, r.dup_id) for r in members.collect()]
    assert len(found) == len(set(found)) and set(found) == want
    assert {(r.keep_id, r.copies) for r in got_groups.collect()} == {(min(g), len(g)) for g in groups.values()}
    hashed = hash_records(df, "pair_id", ["caption"], ["url"])
    assert [tuple(r) for r in collision_count(hashed).collect()] == [(len(groups), 0)]
    assert collapse_records(df.limit(0), "pair_id", ["caption"], ["url"])[1].count() == 0
    assert unicodedata.unidata_version
