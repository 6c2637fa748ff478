import random
import re
import unicodedata
from urllib.parse import urlsplit

import numpy as np

from millrace.llm.mainbody import Page, align, inside_main, main_bodies, surrounding_lines
from millrace.llm.repeats import WINDOW, canonical_line, line_units, natural_cuts, repeated_lines, without_repeated_lines

PAGES = "page_id bigint, page_url string, text string"


def brute(rows, least=6):
    def canon(x):
        return re.sub(r"\d+", "0", re.sub(r"\s+", "", unicodedata.normalize("NFKC", x).lower()))

    pages = {}
    for _, url, text in (r for r in rows if r[0] is not None):
        if url and text is not None and (host := (urlsplit(url).hostname or "").removeprefix("www.")):
            for line in text.split("\n"):
                if canon(line):
                    pages.setdefault((host, canon(line)), set()).add(url)
    out = set()
    for page_id, url, text in (r for r in rows if r[0] is not None):
        host = (urlsplit(url).hostname or "").removeprefix("www.") if url else ""
        for i, line in enumerate(text.split("\n") if text is not None and host else []):
            if len(pages.get((host, canon(line)), ())) >= least:
                out.add((page_id, i))
    return out


def fixture():
    r = random.Random(5)
    long = ["段落" * 400, "段落" * 390 + "その二", "x" * 9000, "記事の免責事項。" * 60]
    rows = []
    for i in range(160):
        site = r.choice(["https://www.A.example:443", "http://a.example", "https://b.example", "https://c.example"])
        lines = [f"固有{chr(0x4e00 + i)}", r.choice(["メニュー", "ＭＥＮＵ", "menu "]), f"© {2000 + i % 9} Site", "", r.choice(long), f"{i} 件", r.choice(["まれ", "時々"])]
        r.shuffle(lines)
        rows.append((i, f"{site}/p/{i % 150}", "\n".join(lines)))
    rows += [(900, None, "メニュー"), (901, "https://a.example/x", None), (902, "https://a.example/y", ""), (903, "not a url", "メニュー")]
    nameless = (None, "https://a.example/p/1", "menu")
    return [nameless, *rows, rows[3], (904, rows[3][1], rows[3][2])]


def test_repeated_lines_against_brute_force(spark):
    rows = fixture()
    df = spark.createDataFrame([(*r, "x") for r in rows], PAGES + ", site string").repartition(3)
    found = [(r.page_id, r.line_no) for r in repeated_lines(df).collect()]
    assert set(found) == brute(rows)
    cut = {r.page_id: r for r in without_repeated_lines(spark.createDataFrame(rows[1:-2], PAGES)).collect()}
    assert cut[901].text is None and cut[901].lines_cut == 0 and cut[902].text == ""
    assert "固有" + chr(0x4e07) in cut[7].text and "menu" not in cut[7].text.lower()
    assert repeated_lines(df.limit(0)).count() == 0


def test_chunks_decide_across_line_ends(spark):
    block = "\n".join(["a", "会", "b2", "店"])  # lines too short to delimit a chunk of their own
    rows = [(i, f"https://a.example/{i}", f"固有の題{i * 7919}\n{block * 3}\n終わり") for i in range(40)]
    df = spark.createDataFrame(rows, PAGES)
    found = repeated_lines(df).collect()
    assert {(r.page_id, r.line_no) for r in found} == brute(rows)
    assert sum(r.by_chunk for r in found) > 0 and not all(r.by_chunk for r in found)
    # Unlike lines, some in a chunk with the line's own bytes, are told apart by chunks alone.
    units = line_units(df).collect()
    several = {u.line_key for u in units if u.within}
    assert len(units) > len({u.chunk_key for u in units if u.within}) > 0 and several


def test_a_line_delimits_the_same_chunk_wherever_it_stands(spark):
    line = "この記事の内容は公開時点のものです。無断転載を禁じます。"
    rows = [(i, f"https://a.example/{i}", f"{'前' * i}{i}\n{line}" + ("" if i % 2 else f"\n後{i}")) for i in range(30)]
    units = [u for u in line_units(spark.createDataFrame(rows, PAGES)).collect() if u.line_no == 1]
    assert len(units) == 30 and len({(u.chunk_key, u.within) for u in units}) == 1 and not units[0].within


def test_cuts_move_with_content():
    data = random.Random(1).randbytes(60_000)
    cuts = natural_cuts(np.frombuffer(data, np.uint8))
    moved = natural_cuts(np.frombuffer(b"prefix" + data, np.uint8))
    assert set((cuts[cuts >= WINDOW] + 6).tolist()) <= set(moved.tolist()) and len(cuts) > 5000
    assert canonical_line(" Ａ１２\t3 ") == "a0"


ARTICLE = "".join(f"<p>これは本文の段落{i}です。少し長い文を続けて書き、内容のある文章にします。</p>\n" for i in range(5))
PAGE = (
    "<html><head><title>t</title><style>p{}</style></head><body><ul><li><a href=/a>ホーム</a><li><a href=/b>会社概要</a></ul>"
    f"<div id=x><h1>見出し</h1>\n{ARTICLE}<p>この記事をシェアする</p></div><div><a href=/c>関連記事</a><br>© 2020</div></body></html>"
)


def lines():
    body = [f"これは本文の段落{i}です。少し長い文を続けて書き、内容のある文章にします。" for i in range(5)]
    return ["ホーム", "会社概要", "", "見出し", *body, "この記事をシェアする", "関連記事", "© 2020"]


def test_main_body(spark):
    assert inside_main("\n".join(lines()), PAGE) == [False, False, False, *[True] * 7, False, False]
    rows = [(1, "\n".join(lines()), PAGE), (2, None, PAGE), (3, "", PAGE), (4, "\n".join(lines()), None), (5, "a\nb", "<p>"), (6, "x", "<" * 50)]
    rows = [(i, f"https://a.example/{i}", "見出し - site", *r) for i, *r in rows] + [(7, None, None, "x", None), (None, "https://a.example/n", None, "x", None)]
    df = spark.createDataFrame([(*r, 9) for r in rows], "page_id bigint, page_url string, title string, text string, html string, line_no int")
    found = {(r.page_id, r.line_no) for r in surrounding_lines(df).collect()}
    assert {x for x in found if x[0] == 1} == {(1, 0), (1, 1), (1, 10), (1, 11)}
    assert {x for x in found if x[0] == 4} == {(4, 0), (4, 1), (4, 10), (4, 11)}  # as on the site's other page
    assert not [x for x in found if x[0] in (2, 3)]
    bodies = {r.page_id: r.body for r in main_bodies(df).collect()}
    assert bodies[2] is None and bodies[1].startswith("見出し") and bodies[1].endswith("シェアする")
    assert surrounding_lines(df.limit(0)).count() == 0


def test_heading_beside_the_paragraphs():
    body = "".join(f"<p>{'本文の長い段落が続きます。' * 5}{i}</p>" for i in range(5))
    nested = f"<body><ul><li><a href=1>メニュー</a><li><a href=2>地図</a></ul><div><h1>題名</h1><div>{body}</div><p>シェアする</p></div><div><a href=3>規約</a><br>© x</div></body>"
    page = Page(nested)
    assert page.inside == [False, False, True, *[True] * 5, True, False, False]


def test_unclosed_and_table_pages():
    table = "<table><tr><td><a href=1>メニュー</a><br><a href=2>地図</a><td><font size=4><b>題</b></font><br>" + "<br><br>".join(["本文が続く長い行です。" * 4] * 4) + "<td><a href=3>規約</a></table>"
    page = Page(table)
    assert [b for b, own in zip(page.blocks, page.inside) if own][0] == "題"
    assert not page.inside[0] and not page.inside[-1]
    assert Page("").blocks == [] and Page("<script>x").blocks == []
    for odd in ("<a " * 100_000, "<a href='" * 50_000, "<p>x" * 50_000, "<div>" * 50_000, "<!--" * 50_000):
        assert len(Page(odd).blocks) == len(Page(odd).inside)
    assert align(["a", "b", "a"], ["a", "x", "b", "a"]) == [0, 2, 3]
