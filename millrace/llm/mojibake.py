"""Garbled text from wrong character encoding (problem 3).

A wrong decoding is treated as a substitution cipher: bytes of an encoding
were written as the letters of an unknown code page.  The runs of such letters
are counted as letter n-grams by source (a site) and by the swap that reads
them best, or by their kind (see :func:`kind_of`) where none does; expectation-maximization then
learns for each of these which byte every letter stands for (see
:mod:`millrace.llm.ciphers`), over all sources together and for every source
with enough of them.  Published code pages are the prior: a single garbled
caption is read with it, many can overrule it, and runs that no published page
reads start from nothing.  Runs that gain by the language's character bigrams
are garbled; ``str.translate`` with the learned table and the encoding's
decoder give the original back.

Code pages of several bytes a character aren't substitutions of single
letters; their runs go back to bytes by the code page itself.  Lost bytes
(U+FFFD) and unmapped code points are signs of a faulty decoding by themselves.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.urls import site
from millrace.llm import ciphers
from millrace.llm.ngrams import START, Counts, Model, coarse, codes_of, gram_indexes, summed
from millrace.plans.lineage import materialise
from millrace.plans.skew import join_hot_aware

#: Published code pages that the learning of letters starts from (names of public codecs, fixed values).
LETTER_PAGES = ("cp1252", "latin-1", "cp1251", "mac_roman", "koi8_r", "cp437", "cp1250", "iso8859_15")
#: Code pages of several bytes a character.
WIDE_PAGES = ("cp932", "euc_jp", "gb18030")
#: Encodings the texts had.
ENCODINGS = ("utf-8", "cp932", "euc_jp")
#: Characters of each encoding in bytes.
_UNITS = {
    "utf-8": re.compile(rb"(?:[\xc2-\xdf][\x80-\xbf]|[\xe0-\xef][\x80-\xbf]{2}|\xf0[\x90-\xbf][\x80-\xbf]{2}|[\xf1-\xf4][\x80-\xbf]{3})+"),
    "cp932": re.compile(rb"(?:[\x81-\x9f\xe0-\xea][\x40-\x7e\x80-\xfc]|[\xa1-\xdf])+"),
    "euc_jp": re.compile(rb"(?:[\xa1-\xf4][\xa1-\xfe])+"),
}
#: Gain in nats a run must have, and the least per character of what it is read as.
GAIN, LEAST_MEAN = 9.0, -9.0
#: Characters of a two-byte encoding that are no accident; in UTF-8, whose form is strict, one is enough.
LEAST_CHARACTERS = 3
#: Share of a run's letters that the parts read by a swap must hold for the run to count as that swap's.
READ_SHARE = 0.6
#: Share of a run's letters that its most frequent one has if it stands out.
LEAST_TOP = 0.15
#: Tables of one encoding are one page's if they have so many letters in common, and this share of them stands for the same bytes.
COMMON_LETTERS, ALIKE = 8, 0.9
#: How often a table is learned anew of all it reads.
REFITS = 3
#: Letter n-grams a source must have of a swap for letters of its own to be learned; fewer are learned from all sources together.
LEAST_OWN = 500

_LOST = re.compile("[�-]")
_CONTROL = re.compile("[\x80-\x84\x86-\x9f]")
#: Letters and symbols that code pages have beyond ASCII.
_BEYOND = "\x80-ϿЀ-ԯ\u0590-\u06ff\u0e00-\u0e7f‐-⁞₠-⃏℀-⏿─-◿ﬀ-ﬆ"
#: Runs that may be letters of a code page: no kana or kanji, two or more from beyond ASCII
#: (and what may be the last one's second byte).
_LETTER_RUN = re.compile(f"[{_BEYOND}](?:[ -;=?-~{_BEYOND}]*[{_BEYOND}])[@-~]?")
#: Runs that may be read with a wide code page: with half-width kana or the kanji that lead bytes of kana turn into.
_WIDE_RUN = re.compile("[^\x00-\x7f]{2,}")
_WIDE_SIGN = re.compile("[｡-ﾟ縺繧繝縲銆銇銈銉]")
#: Stretches that may hold ISO-2022-JP whose escape characters got lost: the designations stay as text.
_PRINTED = re.compile(r"[!-~\x1b]+")
_DESIGNATED = re.compile(r"\x1b?\$[B@]")
_ASCII_AGAIN = re.compile(r"\x1b?\([BJ]")
_TAG = re.compile(r"<[^>]*>")
#: Signs of a wrong decoding, by which texts are kept from the language's clean text.
_SIGNS = re.compile(
    "[\x80-\x84\x86-\x9f�-｡-ﾟ縺繧繝縲]"
    "|[À-ɏЀ-ӿ][\x80-\xbf‐-›€™Ѓѓ]|[\xa1-\xbf\xd7\xf7]{2}|\\$[B@][!-~]{2}"
    "|[À-ԯ][─-◿]|[─-◿][À-ԯ]"
)


def letter_table(page: str) -> dict[int, int]:
    """Code point of each letter of a code page to its byte; bytes the page leaves out stand for themselves."""
    table = {}
    for byte in range(0x80, 0x100):
        try:
            letter = bytes([byte]).decode(page)
        except UnicodeDecodeError:
            letter = chr(byte)
        table[ord(letter)] = byte
    return table


_TABLES = {page: letter_table(page) for page in LETTER_PAGES}
_SWAPS = [(f"{e}>{page}", e, page) for page in LETTER_PAGES for e in ENCODINGS if e != page]
_SCRIPTS = (("latin", "À", "ɏ"), ("greek", "Ͱ", "Ͽ"), ("cyrillic", "Ѐ", "ԯ"), ("hebrew", "\u0590", "\u05ff"), ("arabic", "\u0600", "\u06ff"), ("thai", "\u0e00", "\u0e7f"))


def script_of(run: str) -> str:
    """The script most of a run's letters are of; ``signs`` for none."""
    found = Counter(next((name for name, a, b in _SCRIPTS if a <= c <= b), "signs") for c in run if c > "\x7f")
    found["signs"] = 0
    return min(found, key=lambda x: (-found[x], x))


def kind_of(run: str) -> str:
    """What a run that no page reads is learned with: its script, and its most frequent letter where one stands out.

    The bytes that lead most characters of a language are few, so the letter they became tells swaps of one script apart.
    """
    letters = Counter(c for c in run if c > "\x7f")
    top = min(letters, key=lambda c: (-letters[c], c))
    stands_out = letters[top] >= max(2.0, LEAST_TOP * letters.total())
    return f"?{script_of(run)}{top if stands_out else ''}"


class _Letters(dict):
    """A table for ``translate``: letters to bytes, ASCII as it is, other letters to 0."""

    def __missing__(self, c: int) -> int:
        return 0 if c > 0x7F else c


class Language:
    """Character bigram model of clean text."""

    def __init__(self, counts: np.ndarray):
        self.model = Model(counts, max(3.0, counts[0].sum() * 1e-7), unseen=1e-7, order=2)

    def score(self, texts: list[str]) -> list[float]:
        if not texts:
            return []
        codes, edges = codes_of(texts)
        each = np.where(codes != START, self.model.log_probability(gram_indexes(codes, 2)), 0.0)
        each[edges[1:] - 1] = 0.0  # the end mark
        return np.add.reduceat(each, edges[:-1]).tolist()


def _again(text: str) -> str:
    """Text read wrongly as cp1252 once more, if all of its letters beyond ASCII say so; else as it is."""
    try:
        return text.translate(_TABLES["cp1252"]).encode("latin-1").decode("utf-8")
    except UnicodeError:
        return text


def _wide_readings(run: str) -> Iterator[tuple[str, int, int, str]]:
    """Swap, start, end and original of the parts of a run that are well formed once read back by a wide code page."""
    for page in WIDE_PAGES:
        sizes, parts = [], []
        for c in run:
            try:
                b = c.encode(page)
            except UnicodeEncodeError:
                b = b"\x00"
            parts.append(b)
            sizes.append(len(b))
        data = b"".join(parts)
        starts = np.append(0, np.cumsum(sizes))
        if data.count(b"\x00") * 3 > len(data):
            continue
        for encoding in ENCODINGS:
            if encoding == page or encoding == "cp932" or (page == "gb18030" and encoding != "utf-8"):
                continue
            for match in _UNITS[encoding].finditer(data):
                a, b = match.span()
                if b - a < 2:
                    continue
                i = int(np.searchsorted(starts, a))  # whole characters of the run only
                if starts[i] != a and (match := _UNITS[encoding].match(data, int(starts[i]))):
                    b = match.end()
                j = int(np.searchsorted(starts, b, side="right")) - 1
                if j - i < 2:
                    continue
                original = data[int(starts[i]) : int(starts[j])].decode(encoding, "replace")
                if _whole(original, encoding):
                    yield f"{encoding}>{page}", i, j, original


def _whole(original: str, encoding: str) -> bool:
    lost = original.count("\ufffd")
    return lost <= 1 + len(original) // 4 and len(original) - lost >= (1 if encoding == "utf-8" else LEAST_CHARACTERS)


def _letter_readings(run: str, swaps: list[tuple[str, str, _Letters]]) -> Iterator[tuple[str, int, int, str]]:
    """The same by tables of letters.  A swap whose name ends in ``!`` has read every letter of the run as UTF-8."""
    done: dict[int, bytes] = {}
    for name, encoding, table in swaps:
        data = done.get(id(table))
        if data is None:
            data = done[id(table)] = run.translate(table).encode("latin-1")
        if data.count(b"\x00") * 3 > len(data):
            continue
        learned = "?" in name
        for match in _UNITS[encoding].finditer(data):
            a, b = match.span()
            if b - a >= (4 if learned else 2):
                original = data[a:b].decode(encoding, "replace")
                if _whole(original, encoding):
                    yield name, a, b, original
        if encoding == "utf-8":
            try:
                original = data.decode("utf-8")
            except UnicodeDecodeError:
                continue
            for x in {original, _again(original)}:
                if not _CONTROL.search(x):
                    yield name + "!", 0, len(run), x


def runs_of(text: str) -> list[tuple[str, int, int]]:
    """Kind, start and end of the suspicious runs of a text."""
    out = [("letters", *m.span()) for m in _LETTER_RUN.finditer(text)]
    if _WIDE_SIGN.search(text):
        out += [("wide", *m.span()) for m in _WIDE_RUN.finditer(text) if _WIDE_SIGN.search(m.group())]
    return out


Tables = dict[str, dict[int, int]]


class Reader:
    """Finds and undoes swaps, given the language and the tables learned from all sources.

    Tables are by swap: ``encoding>page`` for one that began as a published
    page, ``encoding>?kind`` for one that began from nothing (see :func:`kind_of`).  A text may
    bring its source's own tables as JSON.
    """

    def __init__(self, counts: np.ndarray, tables: Tables | None = None):
        self.language, self.tables = Language(counts), tables or {}
        shared = {page: _Letters(table) for page, table in _TABLES.items()}
        self.start = {name: (name, e, _Letters({**_TABLES[page], **self.tables[name]}) if name in self.tables else shared[page]) for name, e, page in _SWAPS}
        self.start.update({name: (name, name.split(">")[0], _Letters(t)) for name, t in self.tables.items() if "?" in name})
        self.known: dict[str | None, list[tuple[str, str, _Letters]]] = {None: list(self.start.values())}

    def swaps(self, own: str | None) -> list[tuple[str, str, _Letters]]:
        found = self.known.get(own)
        if found is None:
            if len(self.known) > 500:
                self.known = {None: self.known[None]}
            mine = dict(self.start)
            for name, table in json.loads(own).items():
                before = mine[name][2] if name in mine else {}
                mine[name] = (name, name.split(">")[0], _Letters({**before, **{int(c): b for c, b in table.items()}}))
            found = self.known[own] = list(mine.values())
        return found

    def judge(self, texts: list[str], own: list[str | None]) -> list[list[tuple[int, int, str, str, float]]]:
        """For each text the parts that gain: start, end, swap, original and gain, best first and disjoint."""
        asked: list[tuple[int, int, int, str, str, str]] = []
        for k, text in enumerate(texts):
            swaps = self.swaps(own[k])
            for kind, start, end in runs_of(text):
                run = text[start:end]
                for swap, i, j, original in _wide_readings(run) if kind == "wide" else _letter_readings(run, swaps):
                    asked.append((k, start + i, start + j, swap, original, run[i:j]))
        before, after = self.language.score([x[5] for x in asked]), self.language.score([x[4] for x in asked])
        out: list[list[tuple[int, int, str, str, float]]] = [[] for _ in texts]
        for (k, i, j, swap, original, _), old, new in zip(asked, before, after):
            if new - old >= GAIN and (swap[-1] == "!" or new >= LEAST_MEAN * len(original)):
                out[k].append((i, j, swap, original, new - old))
        for k, parts in enumerate(out):
            if len(parts) > 1:
                parts.sort(key=lambda x: (-x[4], x[0]))
                kept: list[tuple[int, int, str, str, float]] = []
                for part in parts:
                    if all(part[1] <= a or part[0] >= b for a, b, *_ in kept):
                        kept.append(part)
                out[k] = kept
        return out

    def escaped(self, text: str) -> list[tuple[int, int, str]]:
        """Start, end and original of ISO-2022-JP left as text."""
        found = []
        for stretch in _PRINTED.finditer(text):
            at, end = stretch.span()
            while (first := _DESIGNATED.search(text, at, end)) and (last := _ASCII_AGAIN.search(text, first.end(), end)):
                at = last.end()
                body = text[first.end() : last.start()]
                try:
                    original = (b"\x1b$B" + body.encode("ascii") + b"\x1b(B").decode("iso2022_jp") if body else ""
                except UnicodeDecodeError:
                    continue
                if original and self.language.score([original])[0] >= LEAST_MEAN * len(original):
                    found.append((first.start(), last.end(), original))
        return found

    def garbled_by(self, text: str, parts: list) -> bool:
        """Whether a text with these gaining parts is garbled, wholly or in part, restorable or not."""
        return bool(parts or _LOST.search(text) or _CONTROL.search(text)) or ("$B" in text or "$@" in text) and bool(self.escaped(text))

    def restored(self, text: str, own: str | None, depth: int = 3) -> str:
        """The text with every gaining part read anew, again and again for text garbled twice."""
        for _ in range(depth):
            parts = [(i, j, original) for i, j, _, original, _ in self.judge([text], [own])[0]] + self.escaped(text)
            if not parts:
                break
            at, out = 0, []
            for i, j, original in sorted(parts):
                if i >= at:
                    out += [text[at:i], original]
                    at = j
            text = "".join(out) + text[at:]
        return text


def _open(text: str) -> bool:
    """Whether a text has anything to judge."""
    return bool(_LOST.search(text) or _CONTROL.search(text) or _LETTER_RUN.search(text) or _WIDE_SIGN.search(text)) or "$B" in text or "$@" in text


def _segments(text: str, field: str) -> str:
    return text if field != "html.html" else _TAG.sub("\n", text)


#: Rows taken at once: a page may be long.
SLICE = 500
_READ = "field string, row_id bigint, source bigint, text string, slot int, n bigint"
_FIRST = "field string, row_id bigint, source bigint, text string, bad boolean, swap string, x int, y int, z int, n bigint"
_FITS = "source bigint, swap string, letters array<int>, bytes array<int>, n double"


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            yield batch.slice(at, SLICE)


def _names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


def _padded(schema: str, given: dict[str, pa.Array]) -> pa.RecordBatch:
    """A batch of ``schema`` whose other columns are null."""
    kinds = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
    rows = len(next(iter(given.values())))
    fields = [x.split() for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([given[name] if name in given else pa.nulls(rows, kinds[kind]) for name, kind in fields], _names(schema))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts with anything to judge, and after them the counts of the language's clean texts."""
    counts = Counts(2, ciphers.byte_grams, ciphers.BYTE_GRAMS)
    for batch in _slices(batches):
        texts = batch.column("text").to_pylist()
        clean: list[str] = []
        for field, text in zip(batch.column("field").to_pylist(), texts):
            if not _SIGNS.search(text):
                clean += [x for x in _segments(text, field).split("\n") if x.strip()]
        counts.add(clean)
        kept = batch.filter(pa.array([_open(t) for t in texts], pa.bool_()))
        if kept.num_rows:
            yield _padded(_READ, dict(zip(kept.schema.names, kept.columns)))
    slot, n = counts.cells()
    if len(slot):
        yield _padded(_READ, {"slot": slot, "n": n})


def _first(shared: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each text and whether it is garbled by the published pages; then the letter n-grams of runs, by source
        and the swap whose parts hold most of the run."""
        reader = Reader(shared.value)
        total: Counter[tuple[int, str, int, int, int]] = Counter()

        def grams() -> pa.RecordBatch:
            columns = list(zip(*((*key, n) for key, n in total.items())))
            kinds = (pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int64())
            return _padded(_FIRST, {name: pa.array(c, kind) for name, c, kind in zip(("source", "swap", "x", "y", "z", "n"), columns, kinds)})

        for batch in _slices(batches):
            sources, texts = (batch.column(c).to_pylist() for c in ("source", "text"))
            judged = reader.judge(texts, [None] * len(texts))
            bad = pa.array([reader.garbled_by(t, parts) for t, parts in zip(texts, judged)], pa.bool_())
            yield _padded(_FIRST, {**dict(zip(batch.schema.names, batch.columns)), "bad": bad})
            for source, text, parts in zip(sources, texts, judged):
                for run in _LETTER_RUN.finditer(text):
                    grams_of_run = ciphers.letter_grams(run.group())
                    own = [x for x in parts if run.start() <= x[0] and x[1] <= run.end()] if grams_of_run else []
                    if any(_LETTER_RUN.search(x[3]) or x[2][-1] == "!" and len(x[3].encode()) < x[1] - x[0] for x in own):
                        continue  # garbled twice: no cipher of single letters
                    held: Counter[str] = Counter()
                    for i, j, swap, _, _ in own:
                        held[swap.rstrip("!")] += sum(c > "\x7f" for c in text[i:j])
                    swap, letters = max(held.items(), key=lambda x: (x[1], x[0]), default=("", 0))
                    if letters < READ_SHARE * sum(c > "\x7f" for c in run.group()):
                        swap = kind_of(run.group())
                    for gram in grams_of_run:
                        total[source, swap, *gram] += 1
            if len(total) > 300_000:
                yield grams()
                total.clear()
        if total:
            yield grams()

    return run


def _fit(languages: Broadcast, common: Tables | None = None):
    """EM on the n-grams of one source and swap: from its published page, or for every encoding from nothing.

    With ``common``, what all sources together learned, a source begins from
    that: where it fits already there is nothing of its own to learn.
    """
    common = common or {}

    def run(group: pd.DataFrame) -> pd.DataFrame:
        source, swap = int(group["source"].iloc[0]), group["swap"].iloc[0]
        grams, n = group[["x", "y", "z"]].to_numpy(np.int64), group["n"].to_numpy(np.float64)
        encoding, _, page = swap.partition(">")
        shared = {code.name: common[f"{code.name}>{swap}"] for code in ciphers.CODES if not page and f"{code.name}>{swap}" in common}
        out = []
        for code in ciphers.CODES:
            if (page and code.name != encoding) or (shared and code.name not in shared):
                continue
            prior = {**_TABLES[page], **common.get(swap, {})} if page else shared.get(code.name)
            fit = ciphers.learn_mapping(grams, n, code, languages.value[code.name], prior)
            if fit is None or not fit.good():
                continue
            table = {c: b for c, b in fit.table.items() if not prior or prior.get(c) != b}
            if table:
                table = table if page else {**(prior or {}), **table}
                out.append((source, swap if page else f"{code.name}>{swap}", list(table), list(table.values()), fit.grams))
        return pd.DataFrame(out, columns=["source", "swap", "letters", "bytes", "n"])

    return run


def _best_of(languages: Broadcast, tables: Tables):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        """The table that reads most of a kind's n-grams, if it reads enough."""
        grams, n = group[["x", "y", "z"]].to_numpy(np.int64), group["n"].to_numpy(np.float64)
        codes = {code.name: code for code in ciphers.CODES}
        read = {name: ciphers.reads(grams, n, codes[c := name.split(">")[0]], languages.value[c], table) for name, table in tables.items()}
        best = max(read, key=lambda name: (read[name], name))
        rows = [(group["swap"].iloc[0], best)] if read[best] >= READ_SHARE else []
        return pd.DataFrame(rows, columns=["swap", "name"])

    return run


def _refit(languages: Broadcast, tables: Tables):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        """A table learned anew of all n-grams it reads, from itself as the prior."""
        name = group["name"].iloc[0]
        table = tables[name]
        grams, n = group[["x", "y", "z"]].to_numpy(np.int64), group["n"].to_numpy(np.float64)
        code = next(c for c in ciphers.CODES if c.name == name.split(">")[0])
        for _ in range(REFITS):  # letters learned once help to tell the next
            fit = ciphers.learn_mapping(grams, n, code, languages.value[code.name], table, settle=False)
            table = fit.table if fit is not None else table
        return pd.DataFrame([(-1, name, list(table), list(table.values()), float(n.sum()))], columns=["source", "swap", "letters", "bytes", "n"])

    return run


def merged(tables: Tables, sizes: dict[str, float]) -> dict[str, str]:
    """Which tables learned from nothing are one page's: each name's table, the one with most n-grams; it takes the others' further letters."""
    of: dict[str, str] = {}
    for name in sorted(tables, key=lambda x: (-sizes[x], x)):
        code = name.split(">")[0]
        for other in dict.fromkeys(of.values()):
            both = tables[name].keys() & tables[other].keys() if other.split(">")[0] == code else ()
            if len(both) >= COMMON_LETTERS and sum(tables[name][c] == tables[other][c] for c in both) >= ALIKE * len(both):
                of[name] = other
                tables[other] = {**tables[name], **tables[other]}
                break
        else:
            of[name] = name
    return of


class Learned:
    """What was learned of all texts of ``field, row_id, source, text``.

    ``counts`` is the language, ``tables`` those by swap of all sources
    together, ``own`` has ``source, tables`` of the sources with their own,
    ``texts`` every text with anything to judge and whether it is garbled by
    the published pages (``bad``).  Only letters are listed whose byte is
    another than the published page's.  The driver gets the tables of all
    sources together, at most MOST_LETTERS letters for each swap and kind of run;
    those of single sources stay in Spark.
    """

    def __init__(self, texts: DataFrame):
        spark = texts.sparkSession
        read = materialise(texts.select("field", "row_id", "source", "text").coalesce(coarse(texts)).mapInArrow(_read, _READ), "read")
        self.counts, bytes_ = summed(read.filter("slot IS NOT NULL").select("slot", "n"), ciphers.BYTE_GRAMS)
        languages = spark.sparkContext.broadcast(ciphers.languages(bytes_))
        open_texts = read.filter("slot IS NULL").select("field", "row_id", "source", "text")
        first = materialise(open_texts.mapInArrow(_first(spark.sparkContext.broadcast(self.counts)), _FIRST), "judged")
        self.texts = first.filter("swap IS NULL").select("field", "row_id", "source", "text", "bad")
        grams = first.filter("swap IS NOT NULL").groupBy("source", "swap", "x", "y", "z").agg(F.sum("n").alias("n"))
        grams = materialise(grams, "grams")
        together = grams.groupBy("swap", "x", "y", "z").agg(F.sum("n").alias("n")).withColumn("source", F.lit(-1).cast("bigint"))
        together = together.repartition(coarse(texts), "swap")  # few rows, long fits: not in one task
        found = together.groupBy("swap").applyInPandas(_fit(languages), _FITS).collect()
        common: Tables = {r["swap"]: dict(zip(r["letters"], r["bytes"])) for r in found}
        fresh = {name: table for name, table in common.items() if "?" in name}
        one = merged(fresh, {r["swap"]: r["n"] for r in found})
        fresh = {name: fresh[name] for name in sorted(set(one.values()))}
        pages = {name: table for name, table in common.items() if "?" not in name}
        kinds: dict[str, str] = {}
        if fresh:
            # Every kind goes with the table that reads it, and the tables are learned anew of all that is theirs.
            unread = together.filter(F.col("swap").startswith("?"))
            kinds = {r["swap"]: r["name"] for r in unread.groupBy("swap").applyInPandas(_best_of(languages, fresh), "swap string, name string").collect()}
            named = spark.createDataFrame(list(kinds.items()), "swap string, name string")
            theirs = unread.join(named, "swap").groupBy("name", "x", "y", "z").agg(F.sum("n").alias("n"))
            fresh = {r["swap"]: dict(zip(r["letters"], r["bytes"])) for r in theirs.groupBy("name").applyInPandas(_refit(languages, fresh), _FITS).collect()}
        self.tables: Tables = pages | fresh
        common = {**pages, **{f"{name.split('>')[0]}>{kind}": fresh[name] for kind, name in kinds.items() if name in fresh}}
        enough = grams.groupBy("source", "swap").agg(F.sum("n").alias("total")).filter(F.col("total") >= LEAST_OWN).select("source", "swap")
        # One row of each n-gram: however many rows a source has, its group is no larger than the pairs and triples of a code page's letters.
        own = grams.join(enough, ["source", "swap"]).groupBy("source", "swap").applyInPandas(_fit(languages, common), _FITS)
        entry = F.struct("swap", F.map_from_arrays(F.col("letters").cast("array<string>"), "bytes").alias("table"))
        self.own = materialise(own.groupBy("source").agg(F.to_json(F.map_from_entries(F.collect_list(entry))).alias("tables")), "own_tables")

    def with_tables(self) -> DataFrame:
        """``texts`` with ``tables``, their source's own or null."""
        sources = self.texts.groupBy("source").agg(F.count("*").alias("n")).join(self.own, "source", "left")
        return join_hot_aware(self.texts, sources, "source", "row_id", "n", self.texts.count()).drop("n")

    def shared(self) -> Broadcast:
        return self.texts.sparkSession.sparkContext.broadcast((self.counts, self.tables))


def as_texts(df: DataFrame, field: str, id_col: str, text_col: str, url_col: str) -> DataFrame:
    """``field, row_id, source, text`` of a table's non-empty texts; the source is a hash of the site, one for all without."""
    return df.select(
        F.lit(field).alias("field"), F.col(id_col).cast("bigint").alias("row_id"), F.xxhash64(F.coalesce(site(url_col), F.lit(""))).alias("source"), F.col(text_col).alias("text")
    ).filter("text <> ''")


def _garbled_again(shared: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(*shared.value)
        for batch in _slices(batches):
            text, own = (batch.column(c).to_pylist() for c in ("text", "tables"))
            found = [reader.garbled_by(t, parts) for t, parts in zip(text, reader.judge(text, own))]
            yield batch.set_column(batch.schema.get_field_index("bad"), "bad", pa.array(found, pa.bool_()))

    return run


def _judged(texts: DataFrame) -> tuple[DataFrame, Broadcast]:
    """``field, row_id, source, text, bad, tables`` of the texts with anything to judge; language and common tables.

    Texts that the published pages leave open are judged again where
    anything was learned beyond them.
    """
    learned = Learned(texts)
    shared = learned.shared()
    rows = learned.with_tables()
    again = F.lit(True) if learned.tables else F.col("tables").isNotNull()
    rows = rows.select("field", "row_id", "source", "text", "bad", "tables")
    judged = rows.filter(~F.col("bad") & again).mapInArrow(_garbled_again(shared), rows.schema)
    return rows.filter("bad").unionByName(judged.filter("bad")), shared


def garbled_rows(texts: DataFrame) -> DataFrame:
    """``field, row_id`` of the texts garbled wholly or in part.

    Null and empty texts give nothing; texts without a site are a source
    together.  Rows are independent once the tables are learned; an empty
    table gives an empty result.
    """
    return _judged(texts)[0].select("field", "row_id")


def restored_texts(texts: DataFrame) -> DataFrame:
    """``field, row_id, text, restored``: each garbled text with what could be restored of it."""
    judged, shared = _judged(texts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(*shared.value)
        for batch in _slices(batches):
            kept = batch.select(["field", "row_id", "text"])
            better = [reader.restored(t, own) for t, own in zip(*(batch.column(c).to_pylist() for c in ("text", "tables")))]
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(better, pa.string())], ["field", "row_id", "text", "restored"])

    return judged.mapInArrow(run, "field string, row_id bigint, text string, restored string")
