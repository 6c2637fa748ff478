"""Queries of the core operators over whole tables, and the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import predicates as P
from millrace.functions import text as X
from millrace.functions import vectors as V
from millrace.functions.html import extract_pairs, extract_text
from millrace.functions.images import color_count as color_count_of
from millrace.functions.images import distinct_colors
from millrace.functions.jpeg import grey_jpeg
from millrace.functions.urls import host, join_url, site
from millrace.operators import dedup, stats
from millrace.plans import pipeline
from millrace.session import table
from millrace.sources import readers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

# Lists for the lookups (fixed values).
WORDS = ["ロゴ", "バナー", "セール", "IMG_", "No."]
URL_WORDS = ["/common/", "wp-content", "noimage"]
DOMAINS = ["img.asagumo-shashin.example", "cdn.shop.mofunoo-diary0.example", "Static.shop.mofunoo-diary0.example"]

_HOST = "nullif(lower(regexp_extract({c}, '^\\s*[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(\\[[^\\]]*\\]|[^/?#:\\s]*)', 1)), '')"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def note(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return note


def _word_sql(column: str, words: list[str]) -> str:
    return "CASE " + " ".join(f"WHEN contains({column}, '{w}') THEN '{w}'" for w in words) + " END"


def _list_sql(words: list[str]) -> str:
    return ", ".join(f"'{w}'" for w in words)


# Sources and snapshots


@query(
    """WITH ids AS (SELECT DISTINCT snapshot_id AS id FROM url_list WHERE snapshot_id IS NOT NULL),
        parts AS (SELECT string_split(id, '-')[3:] AS p FROM ids),
        weeks AS (SELECT try_cast(p[1] AS INTEGER) AS y, try_cast(p[2] AS INTEGER) AS w FROM parts WHERE len(p) = 2),
        dated AS (SELECT y, w, CAST(date_trunc('week', make_date(y, 1, 4)) AS DATE) + (w - 1) * 7 AS monday FROM weeks WHERE y IS NOT NULL AND w IS NOT NULL)
    SELECT printf('%d-%02d', y, w) AS snapshot_id, printf('https://data.commoncrawl.org/crawl-data/CC-MAIN-%d-%02d/warc.paths.gz', y, w) AS warc_path, CAST(CAST(monday AS DATE) AS VARCHAR) AS monday
    FROM dated WHERE y >= 2013 AND monday BETWEEN DATE '2013-12-30' AND DATE '2014-01-13'"""
)
def snapshot_range(spark: SparkSession, d: str) -> DataFrame:
    """Snapshots of an inclusive range of ISO weeks."""
    ids = table(spark, d, "url_list").select(F.col("snapshot_id").alias("id")).filter("id IS NOT NULL").distinct()
    return readers.select_snapshots(ids, "2014-01", "2014-03").withColumn("monday", F.col("monday").cast("string"))


@query(
    """SELECT snapshot_id, value, CASE WHEN regexp_matches(value, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN value
        ELSE 'https://data.commoncrawl.org/' || regexp_replace(value, '^/+', '') END AS url FROM url_list WHERE value <> ''"""
)
def archive_urls(spark: SparkSession, d: str) -> DataFrame:
    return readers.archive_urls(table(spark, d, "url_list"), "https://data.commoncrawl.org")


@query("SELECT snapshot_id, count(*) AS n, count(DISTINCT value) AS n_distinct FROM url_list WHERE value <> '' GROUP BY 1")
def urls_per_snapshot(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "url_list").filter("value <> ''")
    return lines.groupBy("snapshot_id").agg(F.count("*").alias("n"), F.count_distinct("value").alias("n_distinct"))


@query(
    """SELECT kind, count(*) AS n, CAST(count_if(coalesce(contains(kind, 'html'), false)) AS BIGINT) AS n_html FROM
        (SELECT CASE event_type WHEN 'view' THEN 'text/html' WHEN 'click' THEN 'application/xhtml+xml' WHEN 'purchase' THEN 'TEXT/HTML' ELSE 'image/' || event_type END AS kind FROM events) GROUP BY 1"""
)
def content_type_filter(spark: SparkSession, d: str) -> DataFrame:
    """The content type test on types made of the event types; it minds the case."""
    e = F.col("event_type")
    kind = F.when(e == "view", "text/html").when(e == "click", "application/xhtml+xml").when(e == "purchase", "TEXT/HTML").otherwise(F.concat(F.lit("image/"), e))
    typed = table(spark, d, "events").select(kind.alias("kind"))
    return typed.groupBy("kind").agg(F.count("*").alias("n"), F.count_if(P.is_html_type("kind")).alias("n_html"))


# Pages


@query("SELECT html_id FROM html WHERE regexp_matches(html, '<html[^>]*lang=[\"'']?ja[\"'']?', 'i')")
def html_lang_filter(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "html").filter(P.declares_language("html")).select("html_id")


def _unescape_sql(text: str) -> str:
    fine = "({n} BETWEEN 1 AND 55295 OR {n} BETWEEN 57344 AND 1114111)"
    decimal, digits = "CAST(regexp_extract(x, '^([0-9]{1,7});', 1) AS INTEGER)", "regexp_extract(x, '^[xX]([0-9A-Fa-f]{1,6});', 1)"
    hexadecimal = f"CAST(list_reduce(list_prepend(0, list_transform(string_split(lower({digits}), ''), lambda c: instr('0123456789abcdef', c) - 1)), lambda a, b: a * 16 + b) AS INTEGER)"
    found = f"""array_to_string(list_transform(string_split({text}, '&#'), lambda x, i: CASE WHEN i = 1 THEN x
        WHEN regexp_matches(x, '^[0-9]{{1,7}};') THEN CASE WHEN {fine.format(n=decimal)} THEN chr({decimal}) || substr(x, instr(x, ';') + 1) ELSE '&#' || x END
        WHEN regexp_matches(x, '^[xX][0-9A-Fa-f]{{1,6}};') THEN CASE WHEN {fine.format(n=hexadecimal)} THEN chr({hexadecimal}) || substr(x, instr(x, ';') + 1) ELSE '&#' || x END
        ELSE '&#' || x END), '')"""
    for name, char in (("&nbsp;", "chr(160)"), ("&lt;", "'<'"), ("&gt;", "'>'"), ("&quot;", "chr(34)"), ("&apos;", "chr(39)"), ("&amp;", "'&'")):
        found = f"replace({found}, '{name}', {char})"
    return found


_STRIP = "regexp_replace({x}, '^[\\s\\x{{0B}}\\x{{1C}}-\\x{{1F}}\\x{{85}}\\p{{Z}}]+|[\\s\\x{{0B}}\\x{{1C}}-\\x{{1F}}\\x{{85}}\\p{{Z}}]+$', '', 'g')"


def _title_sql(html: str) -> str:
    doubled = [pattern.replace("'", "''") for pattern in X.TITLE_PATTERNS]
    tried = ", ".join("nullif(" + _STRIP.format(x=_unescape_sql(f"regexp_extract({html}, '{pattern}', 1)")) + ", '')" for pattern in doubled)
    return f"coalesce({tried})"


@query(f"SELECT html_id, title FROM (SELECT html_id, {_title_sql('html')} AS title FROM html WHERE html IS NOT NULL) WHERE title <> ''")
def title_extract(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "html").select("html_id", X.title("html").alias("title")).filter(P.has_text("title"))


_JA = "[\\x{3041}-\\x{30FF}\\x{4E00}-\\x{9FFF}\\x{FF66}-\\x{FF9D}]"
_LETTER = "[\\x{3041}-\\x{30FF}\\x{4E00}-\\x{9FFF}\\x{FF66}-\\x{FF9D}A-Za-z\\x{C0}-\\x{24F}\\x{400}-\\x{4FF}\\x{AC00}-\\x{D7A3}]"
_KANA = "[\\x{3041}-\\x{30FF}\\x{FF66}-\\x{FF9D}]"


def _count_sql(column: str, pattern: str) -> str:
    return f"(length({column}) - length(regexp_replace({column}, '{pattern}', '', 'g')))"


@query(f"SELECT doc_id FROM documents WHERE {_count_sql('text', _KANA)} > 0 AND {_count_sql('text', _JA)} >= 0.3 * {_count_sql('text', _LETTER)}")
def japanese_filter(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").filter(X.is_japanese("text")).select("doc_id")


@query()
def text_extract(spark: SparkSession, d: str) -> DataFrame:
    """Main text of pages; what a page's navigation or table holds isn't part of it."""
    pages = table(spark, d, "html").filter(P.has_text("html")).select("html_id", "html")
    return extract_text(pages).filter(P.has_text("text")).select("html_id", "text")


_RECIPE = "'<html><head><title>t</title><script>x()</script></head><body><nav><a href=\"/\">menu ' || html_id || '</a></nav><h1>題 ' || html_id || '</h1><div><p> first   line &amp; ' || (html_id % 5) || ' </p><p>second<br>third &#x3042;</p><p>second</p></div><table><tr><td>cell</td></tr></table><ul><li>item</ul><footer>end</footer></body>'"


@query("SELECT html_id, '題 ' || html_id || chr(10) || 'first line & ' || (html_id % 5) || chr(10) || 'second' || chr(10) || 'third あ' || chr(10) || 'item' AS text, 't' AS title FROM html")
def text_of_recipe(spark: SparkSession, d: str) -> DataFrame:
    """Main text and title of pages composed around each page's id, of which the right result is known."""
    pages = table(spark, d, "html").select("html_id", F.expr(_RECIPE).alias("html"))
    return extract_text(pages).select("html_id", "text", X.title("html").alias("title"))


@query()
def pairs_extract(spark: SparkSession, d: str) -> DataFrame:
    """Image and caption pairs of the good pages, with the default policies."""
    pages = table(spark, d, "goodhtml").select("page_id", F.col("page_url").alias("url"), "html")
    return extract_pairs(pages, P.is_web_image, P.is_good_caption, "page_id", carry=()).select("page_id", "position", "url", "caption")


_PAGE_SCHEME = "regexp_extract(page_url, '^([A-Za-z]+):', 1)"
_PAGE_ROOT = "regexp_extract(page_url, '^([A-Za-z]+://[^/?#]*)', 1)"


@query(
    f"""SELECT page_id, 0 AS position, {_PAGE_ROOT} || '/i/' || page_id || '.jpg' AS url, 'cap ' || (page_id % 7) AS caption FROM goodhtml WHERE page_url LIKE 'http%'
    UNION ALL SELECT page_id, 1, 'https://cdn.example.com/' || page_id || '.png', 'fig' || page_id FROM goodhtml WHERE page_url LIKE 'http%'
    UNION ALL SELECT page_id, 2, {_PAGE_SCHEME} || '://cdn.example.com/e.png', 'alt only' FROM goodhtml WHERE page_url LIKE 'http%'"""
)
def pairs_of_recipe(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of pages composed around each page's address, of which the right result is known."""
    n = F.col("page_id").cast("string")
    html = F.concat(
        F.lit('<html><body><img src="/i/'), n, F.lit('.jpg" alt=" cap '), (F.col("page_id") % 7).cast("string"), F.lit(' ">'),
        F.lit('<figure><div><img src="https://cdn.example.com/'), n, F.lit('.png" alt="x"></div><figcaption> <b>fig</b> '), n, F.lit(" </figcaption></figure>"),
        F.lit('<figure><img src="//cdn.example.com/e.png" alt="alt only"><figcaption> </figcaption></figure>'),
        F.lit('<img src="" alt="nosrc"><img src="z.jpg"></body></html>'),
    )
    pages = table(spark, d, "goodhtml").filter("page_url LIKE 'http%'").select("page_id", F.lit("t").alias("title"), F.col("page_url").alias("url"), F.lit("").alias("text"), html.alias("html"))
    return extract_pairs(pages, id_col="page_id").select("page_id", "position", "url", "caption")


@query(
    f"""SELECT page_id, {_PAGE_ROOT} || '/img/' || page_id || '.png' AS rooted, {_PAGE_SCHEME} || '://cdn.example.com/' || page_id AS hosted,
        'https://x.example/a?b=' || page_id AS whole FROM goodhtml WHERE page_url LIKE 'http%'"""
)
def join_urls(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "goodhtml").filter("page_url LIKE 'http%'")
    n, base = F.col("page_id").cast("string"), F.col("page_url")
    return pages.select(
        "page_id",
        join_url(base, F.concat(F.lit("/img/"), n, F.lit(".png"))).alias("rooted"),
        join_url(base, F.concat(F.lit("//cdn.example.com/"), n)).alias("hosted"),
        join_url(base, F.concat(F.lit("https://x.example/a?b="), n)).alias("whole"),
    )


@query(f"SELECT pair_id, {_HOST.format(c='url')} AS host, nullif(regexp_replace({_HOST.format(c='page_url')}, '^www\\.', ''), '') AS site FROM pair")
def url_parts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pair").select("pair_id", host("url").alias("host"), site("page_url").alias("site"))


@query("SELECT pair_id, md5(url) AS url_hash, md5(caption) AS caption_hash, regexp_extract(replace(url, '.jpg', '.png'), '([^/]*)$', 1) AS name FROM pair")
def url_hashes(spark: SparkSession, d: str) -> DataFrame:
    pairs = table(spark, d, "pair")
    return pairs.select("pair_id", F.md5("url").alias("url_hash"), F.md5("caption").alias("caption_hash"), X.basename("url", ".jpg", ".png").alias("name"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_fields(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", F.from_json("props", "k BIGINT")["k"].alias("k"))


@query("SELECT doc_id, text FROM documents WHERE text IS NOT NULL")
def decode_documents(spark: SparkSession, d: str) -> DataFrame:
    """Texts read back from their bytes."""
    raw = table(spark, d, "documents").select("doc_id", F.encode("text", "UTF-8").alias("raw")).filter("raw IS NOT NULL")
    return raw.select("doc_id", X.decode_bytes("raw").alias("text"))


# Text and URL predicates


def _repeats_sql(column: str, n: int) -> str:
    return f"""coalesce(len(list_filter(list_distinct(string_split(left({column}, CAST(greatest(length({column}) - {n}, 0) AS INTEGER)), '')), lambda c: c <> '' AND contains({column}, repeat(c, {n})))) > 0, false)"""


@query(f"SELECT pair_id, {_repeats_sql('caption', 3)} AS repeated FROM pair")
def repeated_chars(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pair").select("pair_id", P.repeats_characters("caption", 3).alias("repeated"))


@query("SELECT doc_id FROM documents WHERE length(text) - length(replace(text, chr(10), '')) > 3")
def many_newlines(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").filter(P.many_newlines("text")).select("doc_id")


@query(f"SELECT pair_id FROM pair WHERE {_count_sql('caption', P.EMOJI_CLASS)} > 2")
def many_emojis(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pair").filter(P.many_emojis("caption", 2)).select("pair_id")


@query(f"SELECT pair_id, {_word_sql('caption', WORDS)} AS word FROM pair WHERE {_word_sql('caption', WORDS)} IS NOT NULL")
def ngword_first(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pair").select("pair_id", P.first_word("caption", WORDS).alias("word")).filter("word IS NOT NULL")


@query(f"SELECT pair_id FROM pair WHERE {_word_sql('url', URL_WORDS)} IS NOT NULL")
def url_ngword(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pair").filter(P.contains_any("url", URL_WORDS)).select("pair_id")


@query(f"SELECT pair_id FROM pair WHERE coalesce({_HOST.format(c='url')} NOT IN ({_list_sql(DOMAINS)}), true)")
def blacklist_anti(spark: SparkSession, d: str) -> DataFrame:
    domains = spark.createDataFrame([(x,) for x in DOMAINS], "domain STRING")
    return P.on_listed_host(table(spark, d, "pair"), "url", domains).select("pair_id")


@query(f"SELECT pair_id FROM pair WHERE coalesce({_HOST.format(c='url')} IN ({_list_sql(DOMAINS)}), false) OR {_word_sql('url', URL_WORDS)} IS NOT NULL")
def nsfw_url(spark: SparkSession, d: str) -> DataFrame:
    """On a listed host, or with a listed word."""
    listed = F.coalesce(host("url").isin(DOMAINS), F.lit(False))
    return table(spark, d, "pair").filter(listed | P.contains_any("url", URL_WORDS)).select("pair_id")


@query(
    f"""SELECT pair_id FROM pair WHERE caption <> '' AND NOT {_repeats_sql('caption', 4)} AND length(caption) - length(replace(caption, chr(10), '')) <= 3
        AND {_count_sql('caption', P.EMOJI_CLASS)} <= 3"""
)
def caption_quality(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pair").filter(P.is_good_caption("caption")).select("pair_id")


# Images


_SIZE = "status = 'success' AND original_width >= 150 AND original_height >= 150"


@query(f"SELECT image_id FROM images WHERE {_SIZE} AND original_width / nullif(original_height, 0) BETWEEN 0.5 AND 2")
def image_size(spark: SparkSession, d: str) -> DataFrame:
    keep = P.succeeded("status") & P.large_enough("original_width", "original_height") & P.fair_ratio("original_width", "original_height")
    return table(spark, d, "images").filter(keep).select("image_id")


@query(f"SELECT image_id FROM images WHERE NOT coalesce({_SIZE.split('AND', 1)[1]} AND original_width / nullif(original_height, 0) > 0.5 AND original_width / nullif(original_height, 0) <= 2, false)")
def image_discard(spark: SparkSession, d: str) -> DataFrame:
    """The helper's rule, which also discards a ratio of exactly a half."""
    return table(spark, d, "images").filter(pipeline.discarded_by_helper("original_width", "original_height")).select("image_id")


@query("SELECT image_id, punsafe FROM images WHERE punsafe < 0.1 AND NOT isnan(punsafe)")
def punsafe_filter(spark: SparkSession, d: str) -> DataFrame:
    return pipeline.safe_images(table(spark, d, "images"), "punsafe").select("image_id", "punsafe")


@query("SELECT clip_id, similarity FROM clip WHERE similarity >= 0.1 AND NOT isnan(similarity)")
def similarity_filter(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "clip").filter(P.is_similar("similarity")).select("clip_id", "similarity")


@query(
    f"""WITH good AS (SELECT image_id, pair_id, phash FROM images WHERE {_SIZE} AND original_width / nullif(original_height, 0) BETWEEN 0.5 AND 2
            AND punsafe < 0.1 AND NOT isnan(punsafe) AND phash IS NOT NULL),
        first AS (SELECT image_id, pair_id FROM (SELECT *, row_number() OVER (PARTITION BY phash ORDER BY image_id) AS n FROM good) WHERE n = 1),
        scores AS (SELECT pair_id, max(similarity) AS similarity FROM clip WHERE similarity >= 0.1 AND NOT isnan(similarity) GROUP BY 1)
    SELECT image_id, pair_id, similarity FROM first JOIN scores USING (pair_id)"""
)
def image_pipeline(spark: SparkSession, d: str) -> DataFrame:
    """Size, safety, hash, first of each hash and similarity, stage after stage."""
    images = table(spark, d, "images").select("image_id", "pair_id", "status", "original_width", "original_height", "punsafe", "phash")
    fair = P.succeeded("status") & P.large_enough("original_width", "original_height") & P.fair_ratio("original_width", "original_height")
    good = pipeline.safe_images(images.filter(fair), "punsafe").filter("phash IS NOT NULL").select("image_id", "pair_id", "phash")
    scores = table(spark, d, "clip").filter(P.is_similar("similarity")).groupBy("pair_id").agg(F.max("similarity").alias("similarity"))
    return pipeline.unique_images(good, "image_id").join(scores, "pair_id").select("image_id", "pair_id", "similarity")


# Deduplication


@query("SELECT image_id FROM (SELECT image_id, row_number() OVER (PARTITION BY phash ORDER BY image_id) AS n FROM images WHERE phash IS NOT NULL) WHERE n = 1")
def dedup_first_seen(spark: SparkSession, d: str) -> DataFrame:
    images = table(spark, d, "images").select("image_id", "phash").filter("phash IS NOT NULL")
    return dedup.first_seen(images, "phash", "image_id").select("image_id")


@query("SELECT count(DISTINCT phash) AS n_exact, true AS only_first_rows, true AS nearly_all FROM images")
def dedup_first_seen_bloom(spark: SparkSession, d: str) -> DataFrame:
    """Bounded memory: first rows only, and short of all of them by no more than twice the error rate."""
    images = table(spark, d, "images").select("image_id", "phash").filter("phash IS NOT NULL")
    kept = dedup.first_seen_bloom(images, "phash", "image_id").select("image_id", F.lit(1).alias("n"))
    exact = dedup.first_seen(images, "phash", "image_id").select("image_id", F.lit(1).alias("m"))
    both = exact.join(kept, "image_id", "full").agg(F.count("m").alias("n_exact"), F.count_if(F.col("m").isNull()).alias("more"), F.count("n").alias("n"))
    return both.select("n_exact", (F.col("more") == 0).alias("only_first_rows"), (F.col("n") >= 0.98 * F.col("n_exact")).alias("nearly_all"))


@query(
    """WITH RECURSIVE turn(pair_id, url, caption, kept) AS (
        SELECT pair_id, url, caption, false FROM pair WHERE url IS NOT NULL AND caption IS NOT NULL
        UNION ALL
        SELECT pair_id, url, caption, kept FROM (
            SELECT *, bool_or(kept) OVER (PARTITION BY url) OR bool_or(kept) OVER (PARTITION BY caption) AS gone FROM (
                SELECT pair_id, url, caption,
                    pair_id = min(pair_id) OVER (PARTITION BY url) AND pair_id = min(pair_id) OVER (PARTITION BY caption) AS kept
                FROM turn WHERE NOT kept))
        WHERE kept OR NOT gone)
    SELECT pair_id FROM turn WHERE kept"""
)
def dedup_greedy(spark: SparkSession, d: str) -> DataFrame:
    pairs = table(spark, d, "pair").select("pair_id", "url", "caption")
    return dedup.greedy_two_key(pairs, "url", "caption", "pair_id").select("pair_id")


# Vectors


_NEXT = """a AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
    n AS (SELECT max(vec_id) + 1 - min(vec_id) AS n, min(vec_id) AS low FROM embeddings),
    b AS (SELECT low + (vec_id - low + n - 1) % n AS vec_id, v AS w FROM a, n)"""
_DOT = "list_sum(list_transform(range(1, len({a}) + 1), lambda i: {a}[i] * {b}[i]))"


@query(
    f"""WITH {_NEXT} SELECT vec_id, round(s, 6) AS similarity FROM
        (SELECT vec_id, {_DOT.format(a='v', b='w')} / (greatest(sqrt({_DOT.format(a='v', b='v')}), 1e-8) * greatest(sqrt({_DOT.format(a='w', b='w')}), 1e-8)) AS s FROM a JOIN b USING (vec_id))
        WHERE s >= 0.1"""
)
def cosine_filter(spark: SparkSession, d: str) -> DataFrame:
    """Cosine of each vector with that of the next id, the last with the first, at 0.1 or over; a vector whose next id is missing gives no row."""
    e = table(spark, d, "embeddings").select("vec_id", "embedding")
    low, high = e.agg(F.min("vec_id")).scalar(), e.agg(F.max("vec_id")).scalar()
    n = high + 1 - low
    after = e.select((low + (F.col("vec_id") - low + n - 1) % n).alias("vec_id"), F.col("embedding").alias("next"))
    scored = e.join(after, "vec_id").withColumn("similarity", V.cosine("embedding", "next"))
    return scored.filter(P.is_similar("similarity")).select("vec_id", F.round("similarity", 6).alias("similarity"))


@query(
    f"""WITH a AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
        b AS (SELECT vec_id, list_transform(v, lambda x: x / sqrt({_DOT.format(a='v', b='v')})) AS v FROM a)
    SELECT vec_id, round(v[1], 6) AS first, round({_DOT.format(a='v', b='v')}, 6) AS length FROM b"""
)
def l2_normalise(spark: SparkSession, d: str) -> DataFrame:
    v = table(spark, d, "embeddings").select("vec_id", V.l2_normalise("embedding").alias("v"))
    return v.select("vec_id", F.round(F.element_at("v", 1), 6).alias("first"), F.round(V.dot("v", "v"), 6).alias("length"))


@query(
    """SELECT CAST(dim - 1 AS INTEGER) AS dim, round(avg(x), 6) AS mean, round(var_pop(x), 6) AS variance, count(x) AS n
    FROM (SELECT unnest(CAST(embedding AS DOUBLE[])) AS x, unnest(range(1, len(embedding) + 1)) AS dim FROM embeddings) GROUP BY 1"""
)
def dim_mean_var(spark: SparkSession, d: str) -> DataFrame:
    found = V.dimension_moments(table(spark, d, "embeddings"), "embedding")
    return found.select("dim", F.round("mean", 6).alias("mean"), F.round("variance", 6).alias("variance"), "n")


@query(
    """SELECT label, round(avg(-(t * log2(p + 1e-10) + (1 - t) * log2(1 - p + 1e-10))), 6) AS loss FROM
        (SELECT label, CAST(label % 2 AS DOUBLE) AS t, 1 / (1 + exp(-CAST(embedding[1] AS DOUBLE) * 4)) AS p FROM embeddings) GROUP BY 1"""
)
def bce_log2(spark: SparkSession, d: str) -> DataFrame:
    p = 1 / (1 + F.exp(-F.element_at("embedding", 1).cast("double") * 4))
    scored = table(spark, d, "embeddings").select("label", (F.col("label") % 2).cast("double").alias("t"), p.alias("p"))
    return scored.groupBy("label").agg(F.round(V.binary_cross_entropy(F.col("t"), F.col("p")), 6).alias("loss"))


@query(
    """WITH a AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
        b AS (SELECT vec_id, v, list_sort(v) AS s FROM a),
        c AS (SELECT vec_id, list_transform(v, lambda x: CASE WHEN x > (s[len(s) // 2] + s[len(s) // 2 + 1]) / 2 THEN 1 ELSE 0 END) AS bits FROM b)
    SELECT vec_id, array_to_string(list_transform(range(0, len(bits) // 4), lambda i: printf('%x', bits[4*i+1]*8 + bits[4*i+2]*4 + bits[4*i+3]*2 + bits[4*i+4])), '') AS hash FROM c"""
)
def hash_bits(spark: SparkSession, d: str) -> DataFrame:
    """The perceptual hash's last step on the vectors as 8 x 8 coefficients."""
    return table(spark, d, "embeddings").select("vec_id", V.sign_bits_hex(F.col("embedding").cast("array<double>")).alias("hash"))


@query(
    """WITH a AS (SELECT vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: CAST(floor((x + 1) * 127.5) AS INTEGER)) AS v FROM embeddings)
    SELECT vec_id, CAST(len(list_distinct(v)) AS INTEGER) AS n_colors, CAST(len(list_distinct(list_transform(v, lambda x: x // 16))) AS INTEGER) AS n_coarse FROM a"""
)
def color_count(spark: SparkSession, d: str) -> DataFrame:
    """Distinct values, whole and with four bits, of the vectors as grey pixels."""
    pixels = F.transform(F.col("embedding").cast("array<double>"), lambda x: F.array(F.floor((x + 1) * 127.5).cast("int")))
    p = table(spark, d, "embeddings").select("vec_id", pixels.alias("p"))
    return p.select("vec_id", distinct_colors(F.col("p")).alias("n_colors"), distinct_colors(F.col("p"), 4).alias("n_coarse"))


@query(
    """WITH a AS (SELECT vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: CAST(greatest(least(floor((x + 1) * 127.5), 255), 0) AS INTEGER)) AS v FROM embeddings)
    SELECT vec_id, CAST(len(list_distinct(v)) AS INTEGER) AS n_colors, CAST(len(list_distinct(list_transform(v, lambda x: x // 16))) AS INTEGER) AS n_coarse FROM a"""
)
def jpeg_colors(spark: SparkSession, d: str) -> DataFrame:
    """Colours counted on the bytes of JPEGs, composed of the vectors' values as grey blocks."""
    grey = F.transform(F.col("embedding").cast("array<double>"), lambda x: F.greatest(F.least(F.floor((x + 1) * 127.5), F.lit(255)), F.lit(0)).cast("int"))

    @F.pandas_udf("binary")
    def composed(values: pd.Series) -> pd.Series:
        return values.map(lambda v: grey_jpeg(v.tolist()))

    images = table(spark, d, "embeddings").select("vec_id", composed(grey).alias("jpg"))
    # As large as the picture, so that every block keeps its shade.
    return images.select("vec_id", color_count_of("jpg").alias("n_colors"), color_count_of("jpg", bits=4).alias("n_coarse"))


def _head_sql(head: V.Head) -> str:
    """The head's layers as list arithmetic, with its weights written out."""
    steps, last = [], len(head.layers)
    for i, (weights, bias) in enumerate(head.layers):
        columns = "[" + ", ".join("[" + ", ".join(repr(float(x)) for x in column) + "]" for column in weights.T) + "]"
        value = "list_inner_product(x, w) + bias[i]"
        value = f"greatest({value}, 0)" if i + 1 <= last - head.linear_tail else value
        bias = [float(b) for b in bias]
        steps.append(f"l{i + 1} AS (SELECT vec_id, list_transform({columns}::DOUBLE[][], lambda w, i: {value}) AS x FROM (SELECT *, {bias}::DOUBLE[] AS bias FROM l{i}))")
    return ", ".join(steps)


_HEAD = V.Head.seeded("B32", 8492, 64)


@query(
    f"""WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
        l0 AS (SELECT vec_id, list_transform(v, lambda a: a / greatest(sqrt(list_inner_product(v, v)), 1e-12)) AS x FROM v), {_head_sql(_HEAD)}
    SELECT vec_id, round(1 / (1 + exp(-x[1])), 6) AS punsafe FROM l{len(_HEAD.layers)}"""
)
def head_scores(spark: SparkSession, d: str) -> DataFrame:
    """Safety scores by a seeded head of the B32 shape, narrowed to the vectors' 64 dimensions."""
    return table(spark, d, "embeddings").select("vec_id", F.round(V.head_score("embedding", _HEAD), 6).alias("punsafe"))


@query(
    """WITH a AS (SELECT vec_id, [exp(CAST(embedding[1] AS DOUBLE)), exp(CAST(embedding[2] AS DOUBLE)), exp(CAST(embedding[3] AS DOUBLE))] AS e FROM embeddings),
        b AS (SELECT vec_id, list_transform(e, lambda x: x / list_sum(e)) AS p FROM a)
    SELECT vec_id, round(p[2] + 2 * p[3], 6) AS expected, round(CASE WHEN p[1] >= 0.4 THEN p[1] ELSE 1 - p[1] END, 6) AS positive FROM b"""
)
def expected_label_score(spark: SparkSession, d: str) -> DataFrame:
    """Expected label, and the probability of the positive one, of three-class predictions."""
    e = F.array(*[F.exp(F.element_at("embedding", i).cast("double")) for i in (1, 2, 3)])
    total = F.aggregate(F.col("e"), F.lit(0.0), lambda s, x: s + x)
    p = table(spark, d, "embeddings").select("vec_id", e.alias("e")).select("vec_id", F.transform("e", lambda x: x / total).alias("p"))
    labels = F.array(*[F.lit(f"__label__{i}") for i in range(3)])
    first = F.element_at("p", 1)
    top = F.when(first >= 0.4, F.lit("__label__pos")).otherwise(F.lit("__label__neg"))
    return p.select("vec_id", F.round(V.label_score(labels, F.col("p")), 6).alias("expected"), F.round(V.positive_probability(top, first), 6).alias("positive"))


# Statistics


@query("SELECT page_url AS key, count(*) AS n, min(pair_id) AS first_ord FROM pair GROUP BY 1 ORDER BY n DESC, first_ord LIMIT 10")
def page_topk(spark: SparkSession, d: str) -> DataFrame:
    """The ten pages with most images."""
    return stats.top_groups(stats.group_counts(table(spark, d, "pair"), "page_url", "pair_id"))


@query(f"SELECT {_HOST.format(c='url')} AS key, count(*) AS n, min(html_id) AS first_ord FROM html WHERE url IS NOT NULL GROUP BY 1 ORDER BY n DESC, first_ord LIMIT 10")
def host_topk(spark: SparkSession, d: str) -> DataFrame:
    return stats.top_groups(stats.group_counts(table(spark, d, "html").filter("url IS NOT NULL"), host("url"), "html_id"))


_COUNTS = "counts AS (SELECT page_url AS key, count(*) AS n FROM pair GROUP BY 1)"


@query(f"WITH {_COUNTS} SELECT count(*) AS n_groups, CAST(sum(n) AS BIGINT) AS n_rows, max(n) AS max_n, min(n) AS min_n, round(avg(n), 2) AS mean_n FROM counts")
def group_stats(spark: SparkSession, d: str) -> DataFrame:
    return stats.group_statistics(stats.group_counts(table(spark, d, "pair"), "page_url", "pair_id"))


@query(
    f"""WITH {_COUNTS}, ends AS (SELECT min(n) AS low, max(n) AS high FROM counts)
    SELECT CAST(CASE WHEN high = low THEN 1 ELSE least(floor((n - low) / ((high - low) / 50)) + 1, 50) END AS INTEGER) AS bin, count(*) AS n_groups FROM counts, ends GROUP BY 1"""
)
def group_hist(spark: SparkSession, d: str) -> DataFrame:
    return stats.group_histogram(stats.group_counts(table(spark, d, "pair"), "page_url", "pair_id"))


@query("SELECT 'orders' AS name, count(*) AS n FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'pair', count(*) FROM pair")
def row_count(spark: SparkSession, d: str) -> DataFrame:
    parts = [table(spark, d, name).agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n") for name in ("orders", "lineitem", "pair")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    """SELECT o_orderkey AS key, o_totalprice AS price, NULL AS quantity FROM orders
    UNION ALL SELECT l_orderkey, l_extendedprice, l_quantity FROM lineitem"""
)
def union_files(spark: SparkSession, d: str) -> DataFrame:
    """Shards of different columns on end; a column one lacks is null there."""
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("price"))
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("key"), F.col("l_extendedprice").alias("price"), F.col("l_quantity").alias("quantity"))
    return orders.unionByName(lines, allowMissingColumns=True)
