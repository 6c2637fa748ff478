import gzip
import io
import json
import os

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace import schemas
from millrace.operators import dedup, stats
from millrace.operators.dedup import BloomFilter
from millrace.plans import pipeline
from millrace.plans.skew import join_hot_aware
from millrace.sources import readers, sinks, warc
from millrace.streaming import stages

PAIRS = "ord bigint, url string, caption string"


def greedy(rows):
    urls, captions, kept = set(), set(), []
    for ord, u, c in sorted(rows):
        if u is not None and c is not None and u not in urls and c not in captions:
            urls.add(u)
            captions.add(c)
            kept.append(ord)
    return kept


def kept_by(spark, rows):
    df = spark.createDataFrame([(*r, "x") for r in rows], PAIRS + ", u string").repartition(3)
    return sorted(r.ord for r in dedup.greedy_two_key(df).collect())


def test_greedy_random_with_hot_keys(spark):
    r = np.random.default_rng(7)
    ids = r.permutation(1500)
    rows = [(int(i), "hot" if r.random() < 0.33 else f"u{r.integers(200)}", "hot" if r.random() < 0.33 else f"c{r.integers(200)}") for i in ids]
    rows += [(2000, None, "c"), (2001, "u", None), (2002, "", ""), (2003, "u" * 9000, "c" * 9000)]
    assert kept_by(spark, rows) == greedy(rows)


def test_greedy_chain_and_empty(spark, monkeypatch):
    monkeypatch.setattr(dedup, "PARALLEL_ROUNDS", 2)
    rows = [(i, f"u{(i + 1) // 2}", f"c{i // 2}") for i in range(40)]
    assert kept_by(spark, rows) == greedy(rows)
    assert kept_by(spark, []) == [] and kept_by(spark, [(1, None, None)]) == []


def test_first_seen(spark):
    rows = [(5, "a"), (1, "b"), (2, "a"), (9, None), (3, None), (7, "c"), (8, "c")]
    df = spark.createDataFrame([(*r, 0) for r in rows], "ord bigint, phash string, _first int")
    exact = sorted(r.ord for r in dedup.first_seen(df, "phash", "ord").collect())
    assert exact == [1, 2, 3, 7]
    assert sorted(r.ord for r in dedup.first_seen_bloom(df, "phash", "ord", 1000).collect()) == exact
    assert dedup.first_seen(df.limit(0), "phash", "ord").count() == 0
    many = spark.range(20_000).select(F.col("id").alias("ord"), (F.col("id") % 9000).cast("string").alias("phash"))
    short = dedup.first_seen_bloom(many, "phash", "ord", 9000, 0.01, 4)
    assert 8700 < short.count() <= 9000 and short.filter("ord >= 9000").count() == 0


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(-(2**63), 2**63 - 1), unique=True, max_size=300))
def test_bloom_has_no_misses(keys):
    bloom = BloomFilter(300, 0.01)
    bloom.add(np.array(keys, np.int64))
    assert bloom.contains(np.array(keys, np.int64)).all()


def test_join_hot_aware(spark):
    rows = spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 800).cast("bigint").alias("key"))
    rows = rows.unionByName(spark.createDataFrame([(6000, None)], "id bigint, key bigint"))
    table = rows.filter("key IS NOT NULL").groupBy("key").agg(F.count("*").alias("n"), F.max("id").alias("top")).filter("key < 400")
    want = {(r.id, r.key, r.n, r.top) for r in rows.join(table, "key").collect()}
    got = [(r.id, r.key, r.n, r.top) for r in join_hot_aware(rows, table, "key", "id", "n", 5000, slices=10).collect()]
    assert len(got) == len(want) and set(got) == want


def test_statistics(spark):
    rows = [(i, f"p{i % 7 if i < 70 else 0}") for i in range(100)] + [(200, None)]
    df = spark.createDataFrame(rows, "id bigint, page_url string")
    counts = stats.group_counts(df, "page_url", "id")
    assert [(r.key, r.n) for r in stats.top_groups(counts, 3).collect()] == [("p0", 40), ("p1", 10), ("p2", 10)]
    one = stats.group_statistics(counts).first()
    assert (one.n_groups, one.n_rows, one.max_n, one.min_n, one.mean_n) == (8, 101, 40, 1, 12.63)
    sizes = [40, *[10] * 6, 1]
    hist, _ = np.histogram(sizes, 50)
    assert {r.bin - 1: r.n_groups for r in stats.group_histogram(counts).collect()} == {i: n for i, n in enumerate(hist) if n}
    assert stats.group_histogram(counts.filter("n = 10")).collect()[0].n_groups == 6
    empty = stats.group_counts(df.limit(0), "page_url", "id")
    assert stats.group_statistics(empty).first().n_rows == 0 and stats.group_histogram(empty).count() == 0


def response(url, content_type, body, kind="response", chunked=False):
    if chunked:
        body = b"%x\r\n" % len(body) + body + b"\r\n0\r\n\r\n"
    http = b"HTTP/1.1 200 OK\r\n" + (b"Content-Type: " + content_type + b"\r\n" if content_type else b"") + (b"Transfer-Encoding: chunked\r\n" if chunked else b"") + b"\r\n" + body
    head = f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Target-URI: {url}\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: {len(http)}\r\n\r\n"
    return head.encode() + http + b"\r\n\r\n"


def test_archive_to_pages(spark, tmp_path):
    page = '<html lang="ja"><title>題</title>日本</html>'
    parts = [
        response("http://a.example/", b"text/html", page.encode("euc_jp")), response("http://b.example/", b"text/html", page.encode(), chunked=True),
        response("http://c.example/", b"TEXT/HTML", page.encode()), response("http://d.example/", None, page.encode()),
        response("http://e.example/", b"text/html", b'<html lang="en">'), response("http://f.example/", b"text/html", page.encode(), "request"),
    ]
    with open(tmp_path / "x.warc.gz", "wb") as f:
        for part in parts:
            f.write(gzip.compress(part))
    (tmp_path / "y.warc").write_bytes(b"".join(parts)[:-40])
    (tmp_path / "z.warc").write_bytes(b"")
    warc.register(spark)
    records = spark.read.format("warc").load(str(tmp_path / "x.warc.gz"))
    assert records.count() == 6
    assert sorted((r.url, r.html) for r in pipeline.pages_from_archive(records).collect()) == [("http://a.example/", page), ("http://b.example/", page)]
    cut = spark.read.format("warc").load(f"{tmp_path}/*.warc")
    assert cut.count() == 6 and cut.filter("rec_type = 'damaged'").count() == 1
    (tmp_path / "broken.warc").write_bytes(parts[0] + b"noise\r\nmore noise\r\n" + parts[2] + parts[5])
    (tmp_path / "broken.warc.gz").write_bytes(gzip.compress(parts[0]) + gzip.compress(parts[1])[:-30] + b"\0" * 40)
    kinds = lambda name: [r.rec_type for r in spark.read.format("warc").load(f"{tmp_path}/{name}").collect()]
    assert kinds("broken.warc") == ["response", "damaged", "response", "request"]
    assert kinds("broken.warc.gz")[0] == "response" and kinds("broken.warc.gz")[-1] == "damaged"
    small = spark.read.format("warc").option("largest", 10).load(f"{tmp_path}/broken.warc").collect()
    assert [bytes(r.payload) for r in small] == [b""] * 4 and small[2].url == "http://c.example/"
    from pyarrow import fs

    with fs.LocalFileSystem().open_input_stream(str(tmp_path / "y.warc"), compression=None) as raw:
        assert len(list(warc.records(io.BufferedReader(raw)))) == 6


def test_readers_and_sinks(spark, tmp_path):
    index = tmp_path / "collinfo.json"
    index.write_text(json.dumps([{"id": f"CC-MAIN-{x}"} for x in ("2025-18", "2025-53", "2024-51", "2012", "2009-2010", "x-y", "2012-10")]))
    got = readers.select_snapshots(readers.snapshot_index(spark, str(index)), "2024-51", "2025-18").collect()
    assert sorted((r.snapshot_id, r.warc_path) for r in got) == [(s, f"https://data.commoncrawl.org/crawl-data/CC-MAIN-{s}/warc.paths.gz") for s in ("2024-51", "2025-18")]
    with pytest.raises(ValueError):
        readers.select_snapshots(readers.snapshot_index(spark, str(index)), "2025-18", "2024-51")
    with gzip.open(tmp_path / "a.paths.gz", "wt") as f:
        f.write("x/1.warc.gz\n\nx/2.warc.gz\n")
    assert [r.url for r in readers.path_lists(spark, str(tmp_path / "a.paths.gz"), "https://d.example").collect()] == ["https://d.example/x/1.warc.gz", "https://d.example/x/2.warc.gz"]
    (tmp_path / "words.txt").write_text("b \n\n a\n")
    assert readers.word_list(spark, str(tmp_path / "words.txt")) == ["b", "a"] and readers.word_list(spark, str(tmp_path / "words.txt"), True) == ["b", "", "a"]
    assert [r.value for r in readers.url_list(spark, str(tmp_path / "words.txt"), 1).collect()] == ["b"]
    assert sorted(r.domain for r in readers.domain_list(spark, [str(tmp_path / "words.txt")]).collect()) == ["a", "b"]
    (tmp_path / "safety.yml").write_text("nsfw:\n  nude: 0.2\n  x y: 0.1 # c\naction: obfuscate\n")
    assert [(r.section, r.concept, r.threshold) for r in readers.concept_thresholds(spark, str(tmp_path / "safety.yml")).collect()] == [("nsfw", "nude", 0.2), ("nsfw", "x y", 0.1)]

    df = spark.createDataFrame([(1, "日本", "f/a.parquet"), (2, None, "f/b.parquet")], "n int, t string, origin string")
    sinks.write_json_lines(df.select("n", "t"), str(tmp_path / "j"))
    back = readers.json_lines(spark, str(tmp_path / "j"), schemas.struct("n INT, t STRING"))
    assert sorted((r.n, r.t) for r in back.collect()) == [(1, "日本"), (2, None)]
    (tmp_path / "bad.jsonl").write_text("{oops\n")
    with pytest.raises(Exception):
        readers.json_lines(spark, str(tmp_path / "bad.jsonl")).collect()
    sinks.write_by_origin(df.filter("n = 1"), str(tmp_path / "o"), "origin")
    assert os.listdir(tmp_path / "o" / "origin=a.parquet")
    assert not (tmp_path / "o" / "origin=b.parquet").exists()
    sinks.write_text(df.select(F.col("n").alias("id"), F.coalesce("t", F.lit("-")).alias("value")), str(tmp_path / "t"), "id")
    assert spark.read.text(str(tmp_path / "t" / "id=1")).first().value == "日本"
    sinks.compact(spark, str(tmp_path / "o"), str(tmp_path / "c"), 1)
    made = []
    for _ in range(2):
        sinks.run_stage(spark, lambda: made.append(1) or df, str(tmp_path / "s"))
    assert made == [1] and sinks.exists(spark, str(tmp_path / "s"))
    (tmp_path / "s" / "junk.parquet").write_bytes(b"no parquet")
    assert readers.parquet(spark, str(tmp_path / "s"), skip_corrupt=True, lineage="file").filter("file LIKE '%part%'").count() == 2
    ordered = readers.with_order(readers.parquet(spark, str(tmp_path / "c"))).select("ord.file", "ord.row").collect()
    assert [r.row for r in ordered] == [0]
    assert stats.rows_per_file(spark.read.parquet(str(tmp_path / "c"))).first().n == 1


def test_fetch(spark):
    def fetch(url):
        if "bad" in url:
            raise OSError("no")
        return url.encode()

    def resize(data):
        if data.endswith(b"x"):
            raise ValueError("no image")
        return data[:3], 10, 20

    df = spark.createDataFrame([(1, "abcd"), (2, "bad"), (3, None), (4, "zx")], "id int, url string")
    got = {r.id: (r.jpg, r.status, r.original_width) for r in readers.fetch_images(df, fetch, resize).collect()}
    assert got[1] == (b"abc", "success", 10)
    assert [got[i][1] for i in (2, 3, 4)] == ["failed_to_download", "failed_to_download", "failed_to_resize"]


def test_stage_chain(spark):
    image = np.random.default_rng(0).integers(0, 256, (200, 200, 3)).astype(np.uint8)
    ppm = b"P6\n200 200\n255\n" + image.tobytes()
    flat = b"P6\n200 200\n255\n" + bytes(200 * 200 * 3)
    rows = [(1, ppm, "success", 200, 200, 0.05), (2, ppm, "success", 200, 200, 0.01), (3, flat, "success", 200, 200, 0.01), (4, ppm, "success", 100, 200, 0.01), (5, None, "failed_to_download", None, None, None), (6, ppm, "success", 200, 200, float("nan"))]
    df = spark.createDataFrame(rows, "ord bigint, jpg binary, status string, original_width int, original_height int, score double")
    out = pipeline.unique_images(pipeline.hashed_images(pipeline.safe_images(pipeline.sound_images(df), "score")), "ord")
    assert [r.ord for r in out.collect()] == [1]
    page = '<html lang=ja><title>題名</title><p>これは日本語の本文です</p><img src="/a.jpg" alt="猫の写真"></html>'
    pages = spark.createDataFrame([("https://a.example/", page), ("https://b.example/", "<p>no title</p>")], schemas.RAW_HTML)
    pairs = pipeline.pairs_of_pages(pipeline.good_pages(pages))
    assert [tuple(r) for r in pairs.collect()] == [("https://a.example/a.jpg", "猫の写真", "題名", "https://a.example/", "これは日本語の本文です")]
    assert pairs.schema.names == schemas.PAIR.names


def test_streams(spark, tmp_path):
    source, schema = str(tmp_path / "in"), schemas.struct(PAIRS)
    first = [(1, "a", "x"), (2, "a", "y"), (3, "b", "x")]
    second = [(4, "b", "z"), (5, "c", "x"), (6, "c", "w")]
    seen = []
    for part in (first, second):
        seen += part
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(source)
        stages.greedy_stream(spark, source, schema, str(tmp_path / "out"), str(tmp_path / "seen"), str(tmp_path / "c1")).awaitTermination()
        assert sorted(r.ord for r in spark.read.parquet(str(tmp_path / "out")).collect()) == greedy(seen)
        keep = lambda df: stages.first_seen_stream(df, "url")
        stages.stream_stage(spark, source, schema, keep, str(tmp_path / "f"), str(tmp_path / "c2")).awaitTermination()
    assert sorted(r.url for r in spark.read.parquet(str(tmp_path / "f")).collect()) == ["a", "b", "c"]


def test_seen_table_that_cannot_be_read_fails_the_stream(spark, tmp_path):
    source, schema = str(tmp_path / "in"), schemas.struct(PAIRS)
    spark.createDataFrame([(1, "a", "x")], schema).write.parquet(source)
    (tmp_path / "seen" / "batch=7").mkdir(parents=True)
    (tmp_path / "seen" / "batch=7" / "part-0.parquet").write_bytes(b"no parquet")
    with pytest.raises(Exception):
        stages.greedy_stream(spark, source, schema, str(tmp_path / "out"), str(tmp_path / "seen"), str(tmp_path / "c1")).awaitTermination()


def test_order_of_lists_follows_files_and_lines(spark, tmp_path):
    (tmp_path / "a.txt").write_text("a0\na1\n")
    (tmp_path / "b.txt").write_text("".join(f"b{i}\n" for i in range(200_000)))
    (tmp_path / "c.txt").write_text("c0\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200000")
    try:
        assert [r.value for r in readers.url_list(spark, str(tmp_path), 4).collect()] == ["a0", "a1", "b0", "b1"]
        words = readers.word_list(spark, str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert words == ["a0", "a1", *(f"b{i}" for i in range(200_000)), "c0"]


def test_long_chain_is_whole(spark, monkeypatch):
    monkeypatch.setattr(dedup, "PARALLEL_ROUNDS", 3)
    monkeypatch.setattr(dedup, "RESIDUE_ROWS", 20)
    rows = [(i, f"u{i // 2}", f"c{(i + 1) // 2}") for i in range(60)]  # each row shares a key with the one before
    df = spark.createDataFrame(rows, PAIRS)
    assert sorted(r.ord for r in dedup.greedy_two_key(df, "url", "caption", "ord").collect()) == greedy(rows)


def test_files_are_made_once(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    for name, values in (("a", [1, 2]), ("b", [3]), ("c", [-1])):
        one = str(tmp_path / name)
        spark.createDataFrame([(v,) for v in values], "v int").coalesce(1).write.parquet(one)
        os.makedirs(source, exist_ok=True)
        os.rename(next(str(p) for p in (tmp_path / name).glob("*.parquet")), f"{source}/{name}.parquet")
    make = lambda df: df.filter("v > 0")
    assert sinks.run_files(spark, source, make, target, at_once=2) == 3 and sinks.run_files(spark, source, make, target) == 0
    assert sorted(r.v for r in spark.read.option("recursiveFileLookup", "true").parquet(f"{target}/origin=a.parquet", f"{target}/origin=b.parquet").collect()) == [1, 2, 3]
    assert os.path.isdir(f"{target}/origin=c.parquet")
    import shutil

    shutil.rmtree(f"{target}/origin=b.parquet")
    assert sinks.run_files(spark, source, make, target) == 1 and sinks.run_files(spark, source, make, target, overwrite=True) == 3


def test_shared_folder_is_needed_on_a_cluster():
    from types import SimpleNamespace

    from millrace.plans import lineage

    conf = SimpleNamespace(get=lambda *_: None)
    cluster = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(getConf=lambda: conf, master="spark://host:7077"))
    with pytest.raises(RuntimeError):
        lineage.shared_folder(cluster)


def test_command_line(spark, tmp_path):
    from millrace.__main__ import main, parser

    page = '<html lang="ja"><title>題名</title><p>これは日本語の本文です</p><img src="/a.jpg" alt="猫の写真"><img src="/b.jpg" alt="猫の写真"><img src="/c.jpg" alt="犬の写真"></html>'
    (tmp_path / "x.warc.gz").write_bytes(gzip.compress(response("http://a.example/", b"text/html", page.encode())) + gzip.compress(response("http://b.example/", b"text/html", b"<html lang=en>")))
    run = lambda stage, source, target, *more: main([stage, "--input", str(tmp_path / source), "--output", str(tmp_path / target), *more], spark)
    assert run("pages", "x.warc.gz", "pages") == 1
    assert run("good-pages", "pages", "good") == 1 and run("pairs", "good", "pairs") == 3
    assert run("unique-pairs", "pairs", "unique") == 2
    assert sorted(r.url for r in spark.read.parquet(str(tmp_path / "unique")).collect()) == ["http://a.example/a.jpg", "http://a.example/c.jpg"]
    assert run("unique-pairs", "nowhere", "unique") == 2  # finished before: not made again
    assert run("count", "pairs", "count") == 1 and run("compact", "pairs", "few", "--files", "2", "--max-files", "1", "--overwrite") == 3
    rows = [(i, f"h{i % 3}", 0.05 * i, 0.1 * i) for i in range(6)]
    spark.createDataFrame(rows, "n bigint, phash string, punsafe double, similarity double").coalesce(1).write.parquet(str(tmp_path / "images"))
    assert run("unique-images", "images", "first") == 3 and run("safe-images", "images", "safe") == 2 and run("similar-pairs", "images", "similar") == 5
    assert {r.n for r in spark.read.parquet(str(tmp_path / "first")).collect()} == {0, 1, 2}
    with pytest.raises(SystemExit):
        parser().parse_args(["pages"])


def test_materialise_and_release(spark, tmp_path):
    from millrace.plans import lineage

    before = set(lineage._written)
    df = lineage.materialise(spark.range(3).withColumn("x", F.lit(None).cast("string")), "t")
    path = next(iter(lineage._written - before)).removeprefix("file://")
    assert df.count() == 3 and df.schema.names == ["id", "x"]
    assert lineage.materialise(df.limit(0), "t").schema == df.schema
    kept = set(lineage._written)
    lineage._remove(path)
    assert not os.path.exists(path)
    lineage._written &= kept


def test_package_reaches_the_workers(spark):
    import zipfile

    from millrace import session

    session.ship(spark)
    session.ship(spark)

    def where(batches):
        import millrace
        import pyarrow as pa

        for _ in batches:
            yield pa.RecordBatch.from_arrays([pa.array([millrace.__file__])], ["x"])

    assert "millrace" in spark.range(1).mapInArrow(where, "x string").first().x
    assert zipfile.is_zipfile(next(f for f in spark.sparkContext._python_includes and [__import__("pyspark").SparkFiles.get("millrace.zip")]))
