import datetime
import random
import struct
import zlib
from urllib.parse import urljoin

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.functions import images, predicates as P, text as X, vectors as V
from millrace.functions.dates import iso_monday
from millrace.functions.html import extract_pairs, extract_text, image_captions, main_text
from millrace.functions.urls import host, join_url, site


def column(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.x for r in df.select("i", expr(F.col("v")).alias("x")).orderBy("i").collect()]


def test_repeated_characters(spark):
    r = random.Random(4)
    texts = ["".join(r.choice("ab\n😀") for _ in range(r.randint(0, 9))) for _ in range(800)] + ["笑ったwwww", "", None, "aaaa"]
    for n in (1, 2, 3, 4):
        want = [t is not None and any(t[i] * n in t for i in range(len(t) - n)) for t in texts]
        assert column(spark, texts, lambda c, n=n: P.repeats_characters(c, n)) == want


def test_newlines_and_emojis(spark):
    assert column(spark, ["こんにちは\n\n\n", None], lambda c: P.many_newlines(c, 2)) == [True, False]
    assert column(spark, ["こんにちは\n\n\n", "こんにちは\n\n\n\n"], lambda c: P.many_newlines(c, 3)) == [False, True]
    assert column(spark, ["✨🙏✨"], lambda c: P.many_emojis(c, 2)) == [True]
    assert column(spark, ["✨🙏✨", "😂😂😂😂", "★★★★", None], lambda c: P.many_emojis(c, 3)) == [False, True, False, False]


def test_words_and_hosts(spark):
    assert column(spark, ["18禁映画", "アダルト 18禁", "x", None], lambda c: P.first_word(c, ["アダルト", "18禁"])) == ["18禁", "アダルト", None, None]
    assert column(spark, ["https://porn.com", "a", None], lambda c: P.contains_any(c, ["", "porn"])) == [True, False, False]
    assert column(spark, ["a", None], lambda c: P.contains_any(c, [""], strict=True)) == [True, False]
    urls = ["https://User:p@WWW.Ex.Com:8080/a", "http://0-1avsex.com/test.jpeg", "http://[::1]:80/", "nothing", None, "https:///x"]
    assert column(spark, urls, host) == ["www.ex.com", "0-1avsex.com", "[::1]", None, None, None]
    assert column(spark, urls, site)[0] == "ex.com"
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "i int, url string")
    listed = spark.createDataFrame([("0-1avsex.com",), ("com",), (None,), ("0-1avsex.com",)], "domain string")
    assert [r.i for r in P.on_listed_host(df, "url", listed, keep=True).collect()] == [1]
    assert sorted(r.i for r in P.on_listed_host(df, "url", listed).collect()) == [0, 2, 3, 4, 5]


def test_language(spark):
    pages = ['<HTML lang=ja>', "<html class=a xml:lang='ja-JP'>", '<html lang="en">', "<html lang=jav>", None, ""]
    assert column(spark, pages, P.declares_language) == [True, True, False, True, False, False]
    texts = ["これは日本語の文です", "This is English", "这是中文", "한국어 문장입니다", "これは mixed 日本語テキスト", None, ""]
    assert column(spark, texts, X.is_japanese) == [True, False, False, False, True, False, False]


def test_bounds(spark):
    df = spark.createDataFrame([(150, 300), (300, 150), (150, 301), (149, 149), (None, 200), (200, 0)], "w int, h int")
    assert [r.x for r in df.select((P.large_enough("w", "h") & P.fair_ratio("w", "h")).alias("x")).collect()] == [True, True, False, False, False, False]
    assert [r.x for r in df.select(P.fair_ratio("w", "h", low_included=False).alias("x")).collect()][:2] == [False, True]
    nan = float("nan")
    assert column(spark, [0.1, 0.0999, nan, None], P.is_safe, "double") == [False, True, False, False]
    assert column(spark, [0.1, 0.0999, nan, None], P.is_similar, "double") == [True, False, False, False]


def test_text_functions(spark):
    assert column(spark, ["　 a b \n", "", None], X.strip) == ["a b", "", None]
    assert column(spark, ["<html><TITLE a=b>\n A &amp;lt; B </title>", "<title></title>", "x", None], X.title) == ["A &lt; B", None, None, None]
    odd = ["<title>a&#65;&#x3042;;b &#0;&#99999999;&#xD800;&#</title>", "<title> </title><meta name=x property='og:title' content='og &nbsp;t'>", "<meta content=late property=og:title>", '<meta content="two" property="og:title">', "<h1 class=x>head</h1>"]
    assert column(spark, odd, X.title) == ["aAあ;b &#0;&#99999999;&#xD800;&#", "og \xa0t", None, "two", "head"]
    texts = ["日本語テキスト", "ascii"]
    raw = [texts[0].encode(e) for e in ("utf-8", "euc_jp", "cp932")] + [b"ascii", None]
    assert column(spark, raw, X.decode_bytes, "binary")[0] == texts[0]
    assert column(spark, raw, X.decode_bytes, "binary")[1:] == [texts[0], texts[0], "ascii", None]
    assert column(spark, ["a/b/c.jsonl"], lambda c: X.basename(c, ".jsonl", ".parquet")) == ["c.parquet"]


def test_iso_weeks(spark):
    rows = [(y, w) for y in range(2013, 2027) for w in (1, 2, 26, 52, 53, 0, 54)]
    df = spark.createDataFrame(rows, "y int, w int")
    for r in df.select("y", "w", iso_monday(F.col("y"), F.col("w")).alias("m")).collect():
        try:
            want = datetime.date.fromisocalendar(r.y, r.w, 1)
        except ValueError:
            want = None
        assert r.m == want, r


def test_join_url(spark):
    bases = ["https://a.example/x/y?q#f", "http://h:8/", "https://a.example"]
    refs = ["b.png", "/r.png", "//c.example/d", "https://z.example/e", "../up", "?q=1", "#f", "", "/a/../b", "data:image/png;base64,xx", "javascript:x", " /s.png "]
    rows = [(b, r) for b in bases for r in refs] + [(None, "a"), ("https://a.example", None)]
    df = spark.createDataFrame(rows, "b string, r string")
    for r in df.select("b", "r", join_url("b", "r").alias("x")).collect():
        assert r.x == (None if r.b is None or r.r is None else urljoin(r.b, r.r)), r


FIGURES = [
    ('<figure><figcaption>before</figcaption><img src=a alt=x></figure>', [("a", "before")]),
    ('<figure><img src=a><img src=b><figcaption> two <b>parts</b></figcaption></figure>', [("a", "twoparts"), ("b", "twoparts")]),
    ('<figure><img src=o><figure><img src=i><figcaption>inner</figcaption></figure><figcaption>outer</figcaption></figure>', [("o", "inner"), ("i", "inner")]),
    ('<figure><img src=a><figcaption>open', [("a", "open")]),
    ('<img src=a alt=" s "><img alt=x><img src="" alt=x><img src=b>', [("a", "s")]),
    ('<figure><img src=a alt=alt><figcaption> </figcaption></figure>', [("a", "alt")]),
    ('<figure><img src=a><figcaption>x<script>no</script><!-- c -->y</figcaption></figure>', [("a", "xy")]),
    ("", []), (None, []), ("<<<>>", []),
]


@pytest.mark.parametrize(("html", "want"), FIGURES)
def test_image_captions(html, want):
    assert image_captions(html) == want


def test_extract_pairs_and_text(spark):
    rows = [(1, "t", "https://a.example/p/", "x", FIGURES[1][0] + '<img src="javascript:1" alt=z>', 7), (2, None, None, None, None, 7)]
    df = spark.createDataFrame(rows, "page_id bigint, title string, url string, text string, html string, position int")
    got = extract_pairs(df, P.is_web_image, P.is_good_caption, "page_id").collect()
    assert [(r.url, r.caption, r.position) for r in got] == [("https://a.example/p/a", "twoparts", 0), ("https://a.example/p/b", "twoparts", 1)]
    assert extract_pairs(df.limit(0)).count() == 0
    page = "<title>t</title><nav>menu</nav><p>one</p><div>two<br>three</div><table><td>cell</table><p>one</p><footer>end</footer>"
    assert main_text(page) == "one\ntwo\nthree" and main_text("<nav>x</nav>") is None and main_text(None) is None
    assert extract_text(spark.createDataFrame([(page, "old")], "html string, text string")).first().text == "one\ntwo\nthree"


def png(pixels: np.ndarray, kind: int, filters=(0, 1, 2, 3, 4)) -> bytes:
    height, width, channels = pixels.shape
    lines, above = [], np.zeros(width * channels, np.int64)
    for y in range(height):
        line = pixels[y].ravel().astype(np.int64)
        left = np.append(np.zeros(channels, np.int64), line[:-channels])
        corner = np.append(np.zeros(channels, np.int64), above[:-channels])
        f = filters[y % len(filters)]
        p = left + above - corner
        near = np.where((abs(p - left) <= abs(p - above)) & (abs(p - left) <= abs(p - corner)), left, np.where(abs(p - above) <= abs(p - corner), above, corner))
        guess = [0 * line, left, above, (left + above) // 2, near][f]
        lines.append(bytes([f]) + ((line - guess) & 255).astype(np.uint8).tobytes())
        above = line
    chunk = lambda n, b: struct.pack(">I", len(b)) + n + b + struct.pack(">I", zlib.crc32(n + b))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, kind, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(b"".join(lines))) + chunk(b"IEND", b"")


def test_images(spark):
    pixels = np.random.default_rng(0).integers(0, 256, (40, 50, 3)).astype(np.uint8)
    assert (images.decode_image(png(pixels, 2)) == pixels).all()
    ppm = b"P6\n50 40\n255\n" + pixels.tobytes()
    assert (images.decode_image(ppm) == pixels).all()
    clear = np.dstack([pixels, np.zeros((40, 50), np.uint8)])
    assert (images.decode_image(png(clear, 6)) == 255).all()
    flat = np.full((64, 64, 3), 7, np.uint8)
    data = [png(pixels, 2), png(flat, 2), b"junk", b"", None]
    assert column(spark, data, images.color_count, "binary")[1:] == [1, None, None, None]
    assert column(spark, data, images.color_count, "binary")[0] > 1000
    hashes = column(spark, [png(pixels, 2), ppm, b"x"], images.phash_of, "binary")
    assert hashes[0] == hashes[1] and len(hashes[0]) == 16 and hashes[2] is None
    shifted = images.phash(np.clip(pixels.astype(int) + 5, 0, 255).astype(np.uint8))
    assert bin(int(shifted, 16) ^ int(hashes[0], 16)).count("1") <= 6
    assert images.unique_colors(flat) == 1 and (images.resized(pixels, 40, 50) == pixels).all()


def test_vectors(spark):
    r = np.random.default_rng(1)
    a, b = r.normal(size=(5, 8)), r.normal(size=(5, 8))
    df = spark.createDataFrame([(i, a[i].tolist(), b[i].tolist()) for i in range(5)] + [(5, [0.0] * 8, [0.0] * 8), (6, [1.0], [1.0, 2.0]), (7, None, None)], "i int, a array<double>, b array<double>")
    got = {x.i: x for x in df.select("i", V.cosine("a", "b").alias("c"), V.l2_normalise("a").alias("n")).collect()}
    for i in range(5):
        assert got[i].c == pytest.approx(a[i] @ b[i] / np.linalg.norm(a[i]) / np.linalg.norm(b[i]))
        assert got[i].n == pytest.approx(a[i] / np.linalg.norm(a[i]))
    assert got[5].c == 0 and got[5].n == [0.0] * 8 and got[6].c is None and got[7].c is None
    head = V.Head.seeded("L14", 3, 8)
    scores = {x.i: x.s for x in df.select("i", V.head_score("a", head).alias("s")).collect()}
    x = a / np.linalg.norm(a, axis=1, keepdims=True)
    assert [scores[i] for i in range(5)] == pytest.approx(head(x).tolist()) and scores[6] is None and scores[7] is None
    assert V.Head.seeded("H14", 1)(r.normal(size=(2, 1024))).shape == (2,)
    standard = df.filter("i = 0").select(V.standardise("a", F.col("b"), F.array(*[F.lit(4.0)] * 8)).alias("s")).first().s
    assert standard == pytest.approx((a[0] - b[0]) / 2)


def test_detector_hook(spark):
    detect = lambda texts: ["ja" if any("ぁ" <= c <= "ん" for c in t) else None if t == "?" else "en" for t in texts]
    assert column(spark, ["ねこ", "cat", "?", None, ""], lambda c: X.detected(c, detect)) == ["ja", "en", None, None, "en"]
    assert column(spark, ["ねこ", "cat", None], X.is_detected(detect)) == [True, False, False]
