import os
import sys

import pytest

from millrace.llm.residue import mark_residue

sys.path.insert(0, os.path.dirname(__file__))

NATURAL = [f"{a}市場で撮った{b}（{i}枚目）" for i, (a, b) in enumerate((a, b) for a in ("トラノ", "ミナト", "サクラ", "カモメ") for b in ("朝食", "露天風呂", "鍛冶", "入学式", "鶏舎") * 5)]
GOOD = ["404号室のドアプレート、ミナト会館", "Not Found という題の油絵（サクラ作）", "『はじめてのJavaScript』の表紙（カモメ書房）", "[左から] トラノさん、兄、妹", "写真", "ロゴ"]
BAD = [
    "{{ alt }}", "%site_name%", "[[title]]", "<?php echo $caption; ?>", "ミナト町の{{place}}", "404 Not Found", "ページが見つかりません", "予期しないエラーが発生しました",
    "JavaScriptを有効にしてください", "undefined", "[object Object]", "Lorem ipsum dolor sit amet", "ここに説明文が入ります", "写真：undefined（トラノさん）",
]


def test_residue(spark):
    captions = [*NATURAL, *GOOD, *BAD, None, "", "   ", "長い" * 20000]
    rows = [(i, c, "トラノ市場の朝食", "久しぶりに訪ねた市場。朝食を食べた。", True) for i, c in enumerate(captions)]
    rows.append((None, "写真", None, None, True))
    df = spark.createDataFrame(rows, "pair_id bigint, caption string, page_title string, text string, residue boolean")
    got = {r.row_id: r.residue for r in mark_residue(df).collect()}
    assert len(got) == len(captions) + 1 and got.pop(None) is False
    flagged = {captions[i] for i, bad in got.items() if bad}
    assert len(flagged & set(BAD)) >= len(BAD) - 1
    assert not flagged & set(NATURAL) and len(flagged & set(GOOD)) <= 1
    assert not flagged & {None, "", "   "}
    assert mark_residue(df.limit(0)).count() == 0


def test_frequent_residue(spark):
    natural = [f"{c}、{i}番目" for i, c in enumerate(NATURAL * 8)]
    bad = ["undefined", "404 Not Found", "{{ alt }}"]
    for one in bad:
        captions = [*natural, *["写真"] * 50, *[one] * (len(natural) // 2)]
        df = spark.createDataFrame([(i, c, None, None) for i, c in enumerate(captions)], "pair_id bigint, caption string, page_title string, text string")
        assert {captions[r.row_id] for r in mark_residue(df).filter("residue").collect()} == {one}


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables")
def test_held_out(spark):
    """On captions that the lists and thresholds weren't made from; the natural model is of the test table."""
    from held_out import NATURAL as OTHERS
    from held_out import RESIDUE

    from millrace.llm.residue import NATURAL_ORDER, Detector, fit_natural
    from millrace.session import table

    detector = Detector(*[x[:NATURAL_ORDER].astype("float32") for x in fit_natural(table(spark, "/root/testdata/sf0.01", "pair"))])
    found, wrong = detector.residue(RESIDUE).sum(), detector.residue(OTHERS).sum()
    assert found >= 0.9 * len(RESIDUE) and found >= 0.9 * (found + wrong)
