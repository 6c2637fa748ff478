"""Duplicates hidden by formatting differences (problem 7)."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.plans.lineage import materialise
from millrace.plans.skew import join_hot_aware

_DROPPED = regex.compile(r"[\s\p{P}\p{Cf}]+")
_URL = re.compile(r"([a-z][a-z0-9+.\-]*):(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$", re.DOTALL)
#: Default ports of schemes (fixed values).
_PORTS = {"http": "80", "https": "443", "ftp": "21", "ws": "80", "wss": "443"}


def canonical_text(text: str) -> str:
    """NFKC and lower case, without white space, punctuation (P) and format characters (Cf)."""
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    return _DROPPED.sub("", text.lower())


def canonical_url(url: str) -> str:
    """Lower case, outer white space off, query parameters sorted and empty ones dropped,
    the scheme's default port, one ``/`` at the end of the path and an empty fragment dropped.
    What isn't a URL keeps its text, lower case and stripped."""
    url = url.strip().lower()
    parts = _URL.match(url)
    if not parts:
        return url
    scheme, authority, path, query, fragment = parts.groups()
    if authority is not None and authority.endswith(":" + _PORTS.get(scheme, "-")):
        authority = authority[: authority.rindex(":")]
    elif authority is not None and authority.endswith(":"):
        authority = authority[:-1]
    out = scheme + ":" + ("" if authority is None else "//" + authority) + path.removesuffix("/")
    if query and (kept := sorted(p for p in query.split("&") if p)):
        out += "?" + "&".join(kept)
    return out + ("#" + fragment if fragment else "")


_HASHED = "row_id bigint, h1 bigint, h2 bigint, proof bigint"


def hash_records(df: DataFrame, id_col: str, text_fields: list[str], url_fields: list[str]) -> DataFrame:
    """``row_id, h1, h2`` (the 128-bit hash of the canonical record) and ``proof``, an independent hash.

    Rows with a null id, or in which a field is null or empty as written, are no records and give nothing.
    """
    fields = [*sorted(text_fields), *sorted(url_fields)]
    makers = [canonical_text] * len(text_fields) + [canonical_url] * len(url_fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns[1:]]
            records = (
                "\x00".join([make(v) for make, v in zip(makers, values)]).encode("utf-8", "surrogatepass") for values in zip(*columns)
            )
            both = [(xxhash.xxh3_128_digest(r), xxhash.xxh64_digest(r, 99)) for r in records]
            wide = np.frombuffer(b"".join(a for a, _ in both), np.int64).reshape(-1, 2)
            proof = np.frombuffer(b"".join(b for _, b in both), np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(wide[:, 0].copy()), pa.array(wide[:, 1].copy()), pa.array(proof)], ["row_id", "h1", "h2", "proof"]
            )

    rows = df.select(F.col(id_col).cast("bigint").alias("row_id"), *fields)
    for field in ("row_id", *fields):
        rows = rows.filter(F.col(field).isNotNull() if field == "row_id" else F.col(field) != "")
    return rows.mapInArrow(run, _HASHED)


def copy_groups(hashed: DataFrame) -> DataFrame:
    """One row per record: ``h1, h2, proof, keep_id, copies``, counted with partial sums before the shuffle.

    Two records that shared the 128-bit hash would differ in their proofs and
    make two rows, so none is merged wrongly; :func:`collision_count` reports them.
    """
    return hashed.groupBy("h1", "h2", "proof").agg(F.min("row_id").alias("keep_id"), F.count("*").alias("copies"))


def collapse_records(df: DataFrame, id_col: str, text_fields: list[str], url_fields: list[str]) -> tuple[DataFrame, DataFrame]:
    """Groups of equal records, and members: ``keep_id, copies`` and ``keep_id, dup_id``.

    The smallest id of a group is kept; every other id is a member once.  Ids
    must be unique.  Groups of one have a row with 1 copy and no members.
    """
    hashed = materialise(hash_records(df, id_col, text_fields, url_fields), "records")
    groups = copy_groups(hashed)
    keyed = hashed.withColumn("key", F.xxhash64("h1", "h2", "proof"))
    table = groups.filter("copies > 1").select(
        F.xxhash64("h1", "h2", "proof").alias("key"), "keep_id", "copies", F.col("h1").alias("_h1"), F.col("h2").alias("_h2")
    )
    # The join key has 64 bits; of two groups that share one, the filter keeps the right one.
    members = (
        join_hot_aware(keyed, table, "key", "row_id", "copies", hashed.count())
        .filter("h1 = _h1 AND h2 = _h2 AND row_id <> keep_id")
        .select("keep_id", F.col("row_id").alias("dup_id"))
    )
    return groups.select("keep_id", "copies"), members


def collision_count(hashed: DataFrame) -> DataFrame:
    """``hashes, collisions``: 128-bit hashes, and those that stand for several records."""
    per_hash = hashed.groupBy("h1", "h2").agg(F.min("proof").alias("a"), F.max("proof").alias("b"))
    return per_hash.agg(F.count("*").alias("hashes"), F.count_if(F.col("a") != F.col("b")).alias("collisions"))
