"""Lines repeated across one site's documents (problem 4).

The canonical text of a page, line ends included, is cut by content-defined
chunking: a chunk ends wherever a rolling hash of the last bytes says so.
Distinct pages are counted per site and chunk.  A line that lies wholly in a
chunk of excessively many pages is repeated with it.  A line that spans
several chunks holds some that its own bytes alone delimit; only if the
longest of them is repeated excessively can the line be.  What the chunks
leave open (these candidates, and lines in chunks whose surroundings vary) is
settled by counting the lines themselves.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.urls import site
from millrace.plans.lineage import materialise
from millrace.plans.skew import join_hot_aware

#: Pages of one site on which a line is repeated excessively.
LEAST_PAGES = 6
#: Bytes the rolling hash sees, and bytes of a usual chunk.  Chunks are short so that most lines delimit some of their own.
WINDOW, USUAL = 4, 8

_SPACE = re.compile(r"\s+")
_DIGITS = re.compile(r"\d+")
_BYTE_VALUE = np.random.default_rng(48).integers(0, 1 << 63, 256, np.uint64)
_BYTE_VALUE[0] = 0  # what stands between pages
_MIX = np.uint64(0x9E3779B97F4A7C15)
_UNITS = "page_id bigint, line_no int, page_key bigint, chunk_key bigint, within boolean, line_key bigint"


def canonical_line(line: str) -> str:
    """NFKC, lower case, no white space, each run of digits as one ``0``."""
    if not line.isascii():
        line = unicodedata.normalize("NFKC", line)
    return _DIGITS.sub("0", _SPACE.sub("", line.lower()))


def natural_cuts(data: np.ndarray) -> np.ndarray:
    """Ends of the content-defined chunks of some bytes: where the sum of byte values over WINDOW bytes, mixed, is 0 modulo USUAL."""
    total = np.cumsum(_BYTE_VALUE[data], dtype=np.uint64)
    rolled = total.copy()
    rolled[WINDOW:] -= total[:-WINDOW]
    return np.flatnonzero((rolled * _MIX) >> np.uint64(40) & np.uint64(USUAL - 1) == 0) + 1


class _Lines:
    """Canonical bytes and hash of lines, the short ones remembered."""

    def __init__(self, most: int = 50_000):
        self.known: dict[str, tuple[bytes, int]] = {}
        self.most = most

    def __call__(self, line: str) -> tuple[bytes, int]:
        found = self.known.get(line)
        if found is None:
            data = canonical_line(line).encode("utf-8", "surrogatepass")
            found = data, xxhash.xxh3_64_intdigest(data)
            if len(line) < 200:
                if len(self.known) >= self.most:
                    self.known.clear()
                self.known[line] = found
        return found


def _of_site(hashes: np.ndarray, sites: np.ndarray, kind: int) -> np.ndarray:
    h = (hashes ^ (sites + np.uint64(kind)) * _MIX) * np.uint64(0xBF58476D1CE4E5B9)
    return ((h ^ h >> np.uint64(31)) * np.uint64(0x94D049BB133111EB)).view(np.int64)


def _units_of(pages: list[tuple[int, str, int, str]], lines: _Lines) -> pa.RecordBatch | None:
    """The lines of some pages that aren't empty, each with one chunk (or none that its bytes delimit)."""
    parts: list[bytes] = []
    page, line_no, start, size, line_hash = [], [], [], [], []
    edges = [0]
    at = 0
    for k, (_, _, _, text) in enumerate(pages):
        for i, line in enumerate(text.split("\n")):
            data, h = lines(line)
            if data:
                page.append(k)
                line_no.append(i)
                start.append(at)
                size.append(len(data))
                line_hash.append(h)
            parts += (data, b"\n")
            at += len(data) + 1
        parts.append(bytes(WINDOW))
        at += WINDOW
        edges += (at - WINDOW, at)
    if not page:
        return None
    data = b"".join(parts)
    natural = natural_cuts(np.frombuffer(data, np.uint8))
    cuts = np.union1d(natural, np.array(edges))
    s, page_of = np.array(start), np.array(page)
    e = s + np.array(size)
    after = np.searchsorted(cuts, s, "right")
    within = e <= cuts[after]
    # Chunks between two cuts that both depend on the line's own bytes.
    low, high = np.searchsorted(natural, s + WINDOW), np.searchsorted(natural, e, "right")
    gaps = np.diff(natural)
    a, b = cuts[after - 1].copy(), cuts[after].copy()
    for k in np.flatnonzero(~within & (high - low >= 2)).tolist():
        j = low[k] + int(gaps[low[k] : high[k] - 1].argmax())
        a[k], b[k] = natural[j], natural[j + 1]
    known = within | (high - low >= 2)
    view = memoryview(data)
    chunk_hash = np.array([xxhash.xxh3_64_intdigest(view[x:y]) if z else 0 for x, y, z in zip(a.tolist(), b.tolist(), known.tolist())], np.uint64)
    sites = np.array([xxhash.xxh3_64_intdigest(p[1].encode()) for p in pages], np.uint64)[page_of]
    columns = [
        np.array([p[0] for p in pages])[page_of], np.array(line_no, np.int32), np.array([p[2] for p in pages])[page_of],
        pa.array(np.where(within, _of_site(chunk_hash, sites, 1), _of_site(chunk_hash, sites, 2)), mask=~known), within, _of_site(np.array(line_hash, np.uint64), sites, 3),
    ]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [x.split()[0] for x in _UNITS.split(", ")])


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    lines = _Lines()
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            found = _units_of(list(zip(*(c.to_pylist() for c in batch.slice(at, 500).columns))), lines)
            if found is not None:
                yield found


def _frequent(of: DataFrame, key: str, least_pages: int) -> DataFrame:
    """``key, n_pages, n_rows`` of the keys on so many distinct pages."""
    pages = of.groupBy(key, "page_key").agg(F.count("*").alias("n"))
    return pages.groupBy(key).agg(F.count("*").alias("n_pages"), F.sum("n").alias("n_rows")).filter(F.col("n_pages") >= least_pages)


def line_units(pages: DataFrame) -> DataFrame:
    """One row per line that isn't empty: ``page_id, line_no, page_key, chunk_key, within, line_key``."""
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        site("page_url").alias("site"),
        F.xxhash64("page_url").alias("page_key"),
        "text",
    ).filter("site IS NOT NULL AND text IS NOT NULL AND page_id IS NOT NULL")
    return rows.mapInArrow(_units, _UNITS)


def repeated_lines(pages: DataFrame, least_pages: int = LEAST_PAGES) -> DataFrame:
    """``page_id, line_no, by_chunk``: each occurrence of a line on ``least_pages`` pages of its site.

    ``by_chunk`` says that the chunk around the line decided.  ``pages`` has
    ``page_id, page_url, text``; lines end at ``\\n`` and count from 0.  Pages
    are told apart by ``page_url`` as written, so a page met twice counts once
    but has its lines cut in both rows.  Rows without an id, a site or text
    and lines that are empty once canonical give nothing.  Other columns are
    ignored.
    """
    units = materialise(line_units(pages), "lines")
    n_rows = units.count()
    chunks = _frequent(units.filter("chunk_key IS NOT NULL"), "chunk_key", least_pages)
    met = materialise(join_hot_aware(units, chunks, "chunk_key", "page_id", "n_rows", n_rows, how="left"), "chunked")
    settled = met.filter("within AND n_pages IS NOT NULL")
    # A line that delimits a chunk of its own is out where that chunk isn't repeated.
    rest = met.filter("(within AND n_pages IS NULL) OR (NOT within AND (chunk_key IS NULL OR n_pages IS NOT NULL))").select("page_id", "line_no", "page_key", "line_key")
    known = settled.groupBy("line_key").agg(F.lit(least_pages).cast("bigint").alias("n_pages"), F.lit(0).cast("bigint").alias("n_rows"))
    counted = rest.groupBy("line_key", "page_key").agg(F.count("*").alias("n")).groupBy("line_key").agg(F.count("*").alias("n_pages"), F.sum("n").alias("n_rows"))
    # Lines settled on some pages are repeated on all others; the rest have no occurrence but those counted.
    keys = counted.unionByName(known).groupBy("line_key")
    keys = keys.agg(F.max("n_pages").alias("n_pages"), F.sum("n_rows").alias("n_rows")).filter(F.col("n_pages") >= least_pages).drop("n_pages")
    more = join_hot_aware(rest, keys, "line_key", "page_id", "n_rows", n_rows)
    return settled.select("page_id", "line_no", F.lit(True).alias("by_chunk")).unionByName(more.select("page_id", "line_no", F.lit(False).alias("by_chunk")))


def without_repeated_lines(pages: DataFrame, least_pages: int = LEAST_PAGES) -> DataFrame:
    """``page_id, text, lines_cut``: each row's text without its repeated lines.

    Row for row as ``pages``; ``page_id`` must be unique.  A null text stays
    null with 0 lines cut; a text of nothing but repeated lines becomes ``''``.
    """
    cut = repeated_lines(pages, least_pages).groupBy("page_id").agg(F.collect_set("line_no").alias("_cut"))
    kept = F.filter(F.transform(F.split("text", "\n"), lambda x, i: F.when(~F.array_contains("_cut", i), x)), lambda x: x.isNotNull())
    return (
        pages.select("page_id", "text")
        .join(cut, "page_id", "left")
        .select(
            "page_id",
            F.when(F.col("_cut").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text"),
            F.coalesce(F.size("_cut"), F.lit(0)).alias("lines_cut"),
        )
    )
