"""Queries of the training-data operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import table

#: Field names by their code in problem 1.
SEEN_FIELDS = {1: "pair.url", 2: "pair.caption", 3: "images.phash"}


def _field(code_col: str = "code"):
    return F.element_at(F.create_map(*[x for k, v in SEEN_FIELDS.items() for x in (F.lit(k).cast("tinyint"), F.lit(v))]), F.col(code_col))


def _seen_keys(spark: SparkSession, d: str) -> DataFrame:
    pair, images = table(spark, d, "pair"), table(spark, d, "images")
    field = lambda code, col: F.struct(F.lit(code).cast("tinyint").alias("code"), F.col(col).alias("value"))
    of_pair = pair.select(F.col("pair_id").alias("row_id"), F.explode(F.array(field(1, "url"), field(2, "caption"))).alias("x"))
    of_pair = of_pair.select("x.code", "row_id", "x.value")
    return of_pair.unionByName(images.select(F.lit(3).cast("tinyint").alias("code"), F.col("image_id").alias("row_id"), F.col("phash").alias("value")))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    from millrace.llm.seen import seen_before

    return seen_before(_seen_keys(spark, d))[0].select(_field().alias("field"), "row_id")


def p1_audit(spark: SparkSession, d: str) -> DataFrame:
    from millrace.llm.seen import seen_before

    audit = seen_before(_seen_keys(spark, d))[1]
    return audit.select(_field().alias("field"), "rows", "asked", "behind", "flagged", "false_alarms", "missed", "wrong_share")


def p1_checked(spark: SparkSession, d: str) -> DataFrame:
    """What the audit must come to whatever the layout: rows and repeats by field, none missed, and few answers of the tables wrong."""
    from millrace.llm.seen import seen_before

    audit = seen_before(_seen_keys(spark, d))[1]
    repeated = F.col("flagged") + F.col("behind") - F.col("false_alarms") + F.col("missed")
    return audit.select(_field().alias("field"), "rows", repeated.alias("repeated"), "missed", (F.col("wrong_share") < 1e-3).alias("few_wrong"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    from millrace.llm.mainbody import surrounding_lines

    return surrounding_lines(table(spark, d, "goodhtml"))


def p2_bodies(spark: SparkSession, d: str) -> DataFrame:
    from millrace.llm.mainbody import main_bodies

    return main_bodies(table(spark, d, "goodhtml"))


def _garble_texts(spark: SparkSession, d: str) -> DataFrame:
    from millrace.llm.mojibake import as_texts

    pages = as_texts(table(spark, d, "html"), "html.html", "html_id", "html", "url")
    return pages.unionByName(as_texts(table(spark, d, "pair"), "pair.caption", "pair_id", "caption", "page_url"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    from millrace.llm.mojibake import garbled_rows

    return garbled_rows(_garble_texts(spark, d))


def p3_restored(spark: SparkSession, d: str) -> DataFrame:
    from millrace.llm.mojibake import restored_texts

    return restored_texts(_garble_texts(spark, d))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    from millrace.llm.repeats import repeated_lines

    return repeated_lines(table(spark, d, "goodhtml")).select("page_id", "line_no")


def p4_texts(spark: SparkSession, d: str) -> DataFrame:
    from millrace.llm.repeats import without_repeated_lines

    return without_repeated_lines(table(spark, d, "goodhtml"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    from millrace.llm.residue import mark_residue

    return mark_residue(table(spark, d, "pair")).filter("residue").select(F.col("row_id").alias("pair_id"))


def p5_kept(spark: SparkSession, d: str) -> DataFrame:
    """The pairs without residue, by the id of the pair."""
    from millrace.llm.residue import mark_residue

    return mark_residue(table(spark, d, "pair")).filter("NOT residue").select(F.col("row_id").alias("pair_id"))


#: Pairs of a site that stay in each snapshot.
MOST_PAIRS = 10


def _scored(spark: SparkSession, d: str) -> DataFrame:
    from millrace.llm.capping import best_scores
    from millrace.plans.lineage import materialise

    return materialise(best_scores(table(spark, d, "clip"), table(spark, d, "pair")), "scored")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    from millrace.llm.capping import cut_by_cap

    return cut_by_cap(_scored(spark, d), ["snapshot_id", "site"], "score", "pair_id", max_count=MOST_PAIRS)


def p6_share(spark: SparkSession, d: str) -> DataFrame:
    """Pairs kept when no site may give more than a twentieth of what is kept."""
    from millrace.llm.capping import cap_contributors

    kept = cap_contributors(_scored(spark, d), ["site"], "score", "pair_id", max_share=0.05)
    return kept.select("pair_id", "site", "score")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    from millrace.llm.canonical import collapse_records

    return collapse_records(table(spark, d, "pair"), "pair_id", ["caption"], ["url"])[1]


def p7_groups(spark: SparkSession, d: str) -> DataFrame:
    from millrace.llm.canonical import collapse_records

    return collapse_records(table(spark, d, "pair"), "pair_id", ["caption"], ["url"])[0]


def p7_collisions(spark: SparkSession, d: str) -> DataFrame:
    from millrace.llm.canonical import collision_count, hash_records

    return collision_count(hash_records(table(spark, d, "pair"), "pair_id", ["caption"], ["url"]))


def p7_checked(spark: SparkSession, d: str) -> DataFrame:
    """Copies add up to the rows that have a url and a caption; no group's hash met another record."""
    from millrace.llm.canonical import collapse_records, collision_count, hash_records

    pairs = table(spark, d, "pair")
    groups, found = collapse_records(pairs, "pair_id", ["caption"], ["url"])
    parts = [
        groups.agg(F.sum("copies").alias("n_rows"), (F.sum("copies") - F.count("*")).alias("more")),
        found.agg(F.count("*").alias("found")),
        collision_count(hash_records(pairs, "pair_id", ["caption"], ["url"])).select("collisions"),
    ]
    both = parts[0].unionByName(parts[1], True).unionByName(parts[2], True).agg(*[F.sum(c).alias(c) for c in ("n_rows", "more", "found", "collisions")])
    return both.select("n_rows", (F.col("more") == F.col("found")).alias("all_copies_found"), (F.col("collisions") == 0).alias("no_collision"))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    from millrace.llm.tokens import encode_texts

    return encode_texts(table(spark, d, "documents"))


def p8_decoded(spark: SparkSession, d: str) -> DataFrame:
    """The texts as they come back from their ids; an exact round trip gives each document's text."""
    from millrace.llm.tokens import decode_ids, encode_texts

    return decode_ids(encode_texts(table(spark, d, "documents")))


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    from millrace.llm.mixing import mix_sources

    return mix_sources(table(spark, d, "documents"), table(spark, d, "source_targets"))[0]


def p9_checked(spark: SparkSession, d: str) -> DataFrame:
    """By wished source with documents: no document occurs more often than the source allows, and its tokens are the target's but for those of two documents."""
    from millrace.llm.mixing import mix_sources

    mix, shares = mix_sources(table(spark, d, "documents"), table(spark, d, "source_targets"))
    wished = shares.filter("target_share > 0 AND max_repeats > 0 AND n_tokens > 0")
    sums = wished.agg(F.sum("target_share").alias("whole"), F.sum("mix_tokens").alias("tokens")).first()
    longest = mix.agg(F.max("n_tokens")).first()[0] or 0
    most = mix.groupBy("source").agg(F.max("copies").alias("most"))
    wanted = F.col("target_share") / (sums["whole"] or 1.0) * (sums["tokens"] or 0)
    return wished.join(most, "source", "left").select(
        "source", "n_docs", (F.coalesce("most", F.lit(0)) <= F.col("max_repeats")).alias("within_repeats"), (F.abs(F.col("mix_tokens") - wanted) <= 2 * longest).alias("near_target")
    )


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    from millrace.llm.mixing import mix_sources

    return mix_sources(table(spark, d, "documents"), table(spark, d, "source_targets"))[1]


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    from millrace.llm.subjects import assign_subjects

    return assign_subjects(table(spark, d, "documents"), table(spark, d, "subject_examples")).select("doc_id", "subject")


def p10_composition(spark: SparkSession, d: str) -> DataFrame:
    """Documents, and sentences about it, of each subject."""
    from millrace.llm.subjects import assign_subjects

    found = assign_subjects(table(spark, d, "documents"), table(spark, d, "subject_examples"))
    return found.groupBy("subject").agg(F.count("*").alias("n_docs"), F.avg("share").alias("mean_share"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("p") and name[1].isdigit()}


def oracle_sql() -> dict[str, str]:
    site = "nullif(regexp_replace(lower(regexp_extract(page_url, '^\\s*[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:\\s]*)', 1)), '^www\\.', ''), '')"
    seen = "SELECT '{name}' AS field, {id} AS row_id FROM (SELECT {id}, row_number() OVER (PARTITION BY {col} ORDER BY {id}) AS n FROM {t} WHERE {col} <> '') WHERE n > 1"
    scored = f"""scored AS (
        SELECT p.pair_id, p.snapshot_id, p.site, s.score
        FROM (SELECT pair_id, snapshot_id, {site} AS site FROM pair) p
        JOIN (SELECT pair_id, max(similarity) AS score FROM clip WHERE similarity IS NOT NULL AND NOT isnan(similarity) GROUP BY 1) s USING (pair_id)
        WHERE p.site IS NOT NULL)"""
    return {
        "p1_found": " UNION ALL ".join(
            seen.format(name=n, id=i, col=n.split(".")[1], t=n.split(".")[0]) for n, i in (("pair.url", "pair_id"), ("pair.caption", "pair_id"), ("images.phash", "image_id"))
        ),
        "p6_found": f"""WITH {scored}
            SELECT pair_id FROM (SELECT pair_id, row_number() OVER (PARTITION BY snapshot_id, site ORDER BY score DESC, pair_id) AS n FROM scored)
            WHERE n > {MOST_PAIRS}""",
        "p1_checked": " UNION ALL ".join(
            f"SELECT '{t}.{c}' AS field, count(*) AS rows, count(*) - count(DISTINCT {c}) AS repeated, CAST(0 AS BIGINT) AS missed, true AS few_wrong FROM {t} WHERE {c} <> ''" for t, c in (("pair", "url"), ("pair", "caption"), ("images", "phash"))
        ),
        "p7_checked": "SELECT count(*) AS n_rows, true AS all_copies_found, true AS no_collision FROM pair WHERE url <> '' AND caption <> ''",
        "p9_checked": """SELECT source, n AS n_docs, true AS within_repeats, true AS near_target FROM (SELECT source, count(*) AS n, sum(length(text)) AS c FROM documents GROUP BY 1)
            JOIN source_targets USING (source) WHERE target_share > 0 AND max_repeats > 0 AND c > 0""",
        "p8_decoded": "SELECT doc_id, coalesce(text, '') AS text FROM documents",
        "p6_share": f"""WITH {scored},
            sizes AS (SELECT site, count(*) AS n FROM scored GROUP BY 1),
            levels AS (SELECT c, (SELECT sum(least(n, c)) FROM sizes) AS total FROM (SELECT unnest(range(1, (SELECT max(n) + 1 FROM sizes))) AS c)),
            best AS (SELECT coalesce(max(c), 0) AS c FROM levels WHERE c <= 0.05 * total + 1e-9)
            SELECT pair_id, site, score FROM (SELECT *, row_number() OVER (PARTITION BY site ORDER BY score DESC, pair_id) AS k FROM scored)
            WHERE k <= (SELECT c FROM best)""",
    }
