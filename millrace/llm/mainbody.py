"""Main body of a page, without what surrounds it (problem 2).

Composite text density (Sun, Song and Liao, "DOM based content extraction via
text density", SIGIR 2011): every DOM node gets its characters per tag,
adjusted by its links; the densities of a node's children are summed, and the
subtree of the largest sum holds the main body.  Runs of text that line breaks
part inside one block count as children, so that pages built of ``td`` and
``br`` are read like those built of ``div`` and ``p``.

The page's extracted lines are laid along the DOM's blocks in order; those that
fall outside the subtree are the surroundings.
"""

from __future__ import annotations

import html as entities
import math
import re
import unicodedata
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.urls import site
from millrace.plans.lineage import materialise
from millrace.plans.skew import join_hot_aware

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)>", re.DOTALL
)
#: HTML element kinds (fixed values).
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template textarea select svg iframe".split())
_HEAD = frozenset("title head".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var".split()
)
#: An opening tag that ends open elements of these names, up to the barrier.
_ENDS = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}
_NOT_IN_P = frozenset(
    "address article aside blockquote center details dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
_BLANK = re.compile(r"\s+")
_DIGITS = re.compile(r"\d+")


class Page:
    """Blocks and density of one page's DOM.

    ``blocks`` are the texts in order of the document; ``inside`` says for
    each whether it belongs to the main body.
    """

    def __init__(self, html: str):
        # Node columns: parent, characters, tags, link characters, link tags.
        self.parent, self.chars, self.tags, self.link_chars, self.link_tags = [-1], [0], [0], [0], [0]
        self.name = [""]
        self.blocks: list[str] = []
        self.home: list[int] = []  # node of each block
        self.runs: list[tuple[int, int, int, int]] = []  # node, characters, link characters, link tags
        self._read(html)
        self.inside = self._main()

    def _read(self, html: str) -> None:
        stack = [0]
        text: list[str] = []
        links = link_chars = link_tags = 0
        at, body, skipped = 0, 0, ""
        parent, name = self.parent, self.name
        opened: Counter[str] = Counter()  # open elements by name

        def flush() -> None:
            nonlocal link_chars, link_tags
            if text:
                whole = entities.unescape("".join(text))
                size = len(_BLANK.sub("", whole))
                if size:
                    node = stack[-1]
                    self.blocks.append(whole)
                    self.home.append(node)
                    self.runs.append((node, size, min(link_chars, size), link_tags))
                    self.chars[node] += size
                    self.link_chars[node] += min(link_chars, size)
                text.clear()
            link_chars = link_tags = 0

        def close_to(depth: int) -> None:
            while len(stack) > depth:
                child = stack.pop()
                opened[name[child]] -= 1
                up = stack[-1]
                self.chars[up] += self.chars[child]
                self.tags[up] += self.tags[child] + 1
                self.link_chars[up] += self.link_chars[child]
                self.link_tags[up] += self.link_tags[child]

        for found in _MARKUP.finditer(html):
            start, end = found.span()
            if start > at and not skipped:
                piece = html[at:start]
                text.append(piece)
                if links:
                    link_chars += len(_BLANK.sub("", entities.unescape(piece)))
            at = end
            tag = found.group(2)
            if tag is None:
                continue
            tag = tag.lower()
            closing = bool(found.group(1))
            if skipped:
                if closing and tag == skipped:
                    skipped = ""
                continue
            if tag in _RAW or tag in _HEAD and tag != "head":
                if not closing and not found.group(3).endswith("/"):
                    skipped = tag
                continue
            if tag in _INLINE:
                node = stack[-1]
                if not closing:
                    self.tags[node] += 1
                if tag == "a":
                    if closing:
                        links = 0
                    else:
                        links = 1
                        link_tags += 1
                        self.link_tags[node] += 1
                continue
            flush()
            if tag in _VOID:
                if not closing:
                    self.tags[stack[-1]] += 1
                continue
            if closing:
                for depth in range(len(stack) - 1 if opened[tag] else 0, 0, -1):
                    if name[stack[depth]] == tag:
                        close_to(depth)
                        break
                links = 0
                continue
            if tag in _ENDS:
                names, barrier = _ENDS[tag]
                for depth in range(len(stack) - 1, 0, -1):
                    own = name[stack[depth]]
                    if own in names:
                        close_to(depth)
                        if own == tag or tag != "tr":
                            break
                    elif own in barrier:
                        break
            elif tag in _NOT_IN_P and name[stack[-1]] == "p":
                close_to(len(stack) - 1)
            if tag == "body":
                body = len(parent)
            parent.append(stack[-1])
            name.append(tag)
            for column in (self.chars, self.tags, self.link_chars, self.link_tags):
                column.append(0)
            stack.append(len(parent) - 1)
            opened[tag] += 1
            links = 0
        if at < len(html) and not skipped:
            tail = html[at:]
            text.append(tail.split("<", 1)[0] if "<" in tail else tail)
        flush()
        close_to(1)
        self.body = body

    def _density(self, c: int, t: int, lc: int, lt: int, ratio: float) -> float:
        if c == 0:
            return 0.0
        t, lc1, lt1, plain = max(t, 1), max(lc, 1), max(lt, 1), max(c - lc, 1)
        base = math.log(c / plain * lc + ratio * c + math.e)
        inner = c / lc1 * t / lt1
        return c / t * math.log(inner) / math.log(base) if inner > 1 and base > 1 else 0.0

    def _main(self) -> list[bool]:
        n = len(self.parent)
        if not self.blocks:
            return []
        ratio = self.link_chars[self.body] / max(self.chars[self.body], 1)
        density = [self._density(self.chars[i], self.tags[i], self.link_chars[i], self.link_tags[i], ratio) for i in range(n)]
        total = [0.0] * n
        for i in range(1, n):
            total[self.parent[i]] += density[i]
        for node, c, lc, lt in self.runs:
            total[node] += self._density(c, 1, lc, lt, ratio)
        best = max(range(n), key=lambda i: (total[i], -i))
        # Widen along the path to the body while a subtree is nearer to the best's density than to the body's:
        # headings beside the block of paragraphs come in, menus don't.
        threshold = (density[best] + density[self.body]) / 2
        while (up := self.parent[best]) > 0 and up != self.body and density[up] >= threshold:
            best = up
        self.best = best
        under = [False] * n
        under[best] = True
        for i in range(best + 1, n):  # children come after their parents
            if self.parent[i] >= 0 and under[self.parent[i]]:
                under[i] = True
        return [under[h] for h in self.home]


def _plain(text: str) -> str:
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    return _BLANK.sub("", text)


def align(lines: list[str], blocks: list[str]) -> list[int]:
    """For each line the block it is, in order of both, or -1: the longest common subsequence."""
    where: dict[str, list[int]] = {}
    for i, block in enumerate(blocks):
        where.setdefault(block, []).append(i)
    tails: list[int] = []
    tail_entry: list[int] = []
    entries: list[tuple[int, int, int]] = []  # line, block, previous entry
    for k, line in enumerate(lines):
        if not line:
            continue
        for block in reversed(where.get(line, ())):
            at = bisect_left(tails, block)
            entries.append((k, block, tail_entry[at - 1] if at else -1))
            if at == len(tails):
                tails.append(block)
                tail_entry.append(len(entries) - 1)
            else:
                tails[at] = block
                tail_entry[at] = len(entries) - 1
    found = [-1] * len(lines)
    entry = tail_entry[-1] if tail_entry else -1
    while entry >= 0:
        k, block, entry = entries[entry]
        found[k] = block
    return found


def _densest_run(weights: list[float]) -> list[bool]:
    """The run of lines of largest sum, as the main body of lines without a DOM."""
    best, total, start = (0.0, 0, -1), 0.0, 0
    for i, w in enumerate(weights):
        if total <= 0:
            total, start = 0.0, i
        total += w
        if total > best[0]:
            best = (total, start, i)
    return [best[1] <= i <= best[2] for i in range(len(weights))]


def inside_main(text: str, html: str | None) -> list[bool] | None:
    """For each line of ``text`` whether it belongs to the main body; None where the DOM can't tell.

    Lines that meet no block of the DOM go with their neighbours: inside if
    the nearest lines met on both sides are.  The DOM can't tell if there is
    none or if it meets less than a third of the lines.
    """
    lines = [_plain(x) for x in text.split("\n")]
    page = Page(html) if html else None
    if page is None or not page.blocks:
        return None
    blocks = [_plain(b) for b in page.blocks]
    at = align(lines, blocks)
    if sum(b >= 0 for b in at) * 3 < sum(1 for x in lines if x):
        return None
    known = {i: page.inside[b] for i, b in enumerate(at) if b >= 0}
    where: dict[str, bool] = {}
    for b, own in zip(blocks, page.inside):
        where.setdefault(b, own)
    after_of: list[bool | None] = [None] * len(lines)
    before = after = None
    for i in range(len(lines) - 1, -1, -1):
        after_of[i] = after
        after = known.get(i, after)
    out = []
    for i, line in enumerate(lines):
        if i in known or not line:
            out.append(known.get(i, False))
        elif line in where:
            out.append(where[line])
        else:
            sides = [x for x in (before, after_of[i]) if x is not None]
            out.append(all(sides) if sides else True)
        before = known.get(i, before)
    return out


#: Weight of a line on which the site's other pages agree or that is the page's title, and length of a line as likely within as without.
VOTE, EVEN_LENGTH = 60.0, 22
#: Lines that read like sentences or entries of a list weigh a little, however short.
_PROSE = re.compile(r"^[●・*]|^\d+\)|[。!?、]$")
_LINES = "page_id bigint, line_no int, line_key bigint, weight double, inside boolean"


def _own_weight(plain: str, title: str) -> float:
    """What a line's own form says for the main body."""
    if len(plain) >= 4 and plain in title:
        return VOTE
    return max(len(plain) - EVEN_LENGTH, 5.0 if _PROSE.search(plain) else -EVEN_LENGTH)


def _label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in _LINES.split(", ")]
    for batch in batches:
        ids: list[int] = []
        numbers: list[int] = []
        keys: list[int] = []
        weights: list[float] = []
        labels: list[bool | None] = []
        for page_id, site_name, title, text, html in zip(*(c.to_pylist() for c in batch.columns)):
            known = inside_main(text, html)
            title = _plain(title or "")
            seed = xxhash.xxh3_64_intdigest((site_name or "").encode())
            for i, line in enumerate(text.split("\n")):
                plain = _plain(line)
                if line.strip():
                    ids.append(page_id)
                    numbers.append(i)
                    keys.append(xxhash.xxh3_64_intdigest(_DIGITS.sub("0", plain).encode("utf-8", "surrogatepass"), seed) - (1 << 63))
                    weights.append(0.0 if known else _own_weight(plain, title))
                    labels.append(known[i] if known else None)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(numbers, pa.int32()), pa.array(keys, pa.int64()), pa.array(weights, pa.float64()), pa.array(labels, pa.bool_())], names
        )


def _decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of pages without a DOM, from their lengths and the votes on them."""
    for batch in batches:
        ids: list[int] = []
        numbers: list[int] = []
        for page_id, lines in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            lines = sorted(lines, key=lambda x: x["line_no"])
            votes = [(x["n_in"] or 0) - (x["n_out"] or 0) for x in lines]
            body = _densest_run([VOTE if v > 0 else -VOTE if v < 0 else x["weight"] for v, x in zip(votes, lines)])
            for v, own, x in zip(votes, body, lines):
                if v < 0 or (v == 0 and not own):
                    ids.append(page_id)
                    numbers.append(x["line_no"])
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(numbers, pa.int32())], ["page_id", "line_no"])


def surrounding_lines(pages: DataFrame) -> DataFrame:
    """``page_id, line_no``: the non-empty lines of ``text`` outside the page's main body.

    ``pages`` has ``page_id`` (unique),
    ``page_url, title, text, html``; lines end at
    ``\\n`` and count from 0.  A null or empty text and a null id give no rows.  Where html
    is null, empty or doesn't match the text, a line is judged as it is on the
    other pages of its site, and a line met nowhere else by the run of long
    lines it stands in.  Other columns are ignored.
    """
    given = pages.select(F.col("page_id").cast("bigint").alias("page_id"), site("page_url").alias("site"), "title", "text", "html")
    lines = materialise(given.filter("text <> '' AND page_id IS NOT NULL").mapInArrow(_label, _LINES), "labels")
    found = lines.filter("NOT inside").select("page_id", "line_no")
    open_lines = lines.filter("inside IS NULL").select("page_id", "line_no", "line_key", "weight")
    votes = (
        lines.groupBy("line_key")
        .agg(F.count_if("inside").alias("n_in"), F.count_if(~F.col("inside")).alias("n_out"), F.count_if(F.col("inside").isNull()).alias("n_open"))
        .filter("n_open > 0")
    )
    judged = join_hot_aware(open_lines, votes, "line_key", "page_id", "n_open", open_lines.count())
    by_page = judged.groupBy("page_id").agg(F.collect_list(F.struct("line_no", "weight", "n_in", "n_out")).alias("lines"))  # one page's lines
    return found.unionByName(by_page.mapInArrow(_decide, "page_id bigint, line_no int"))


def main_bodies(pages: DataFrame) -> DataFrame:
    """``page_id, body``: each row's text without the lines outside the main body, and without the empty lines at its ends then; a null text stays null."""
    cut = surrounding_lines(pages).groupBy("page_id").agg(F.collect_set("line_no").alias("_cut"))
    kept = F.filter(F.transform(F.split("text", "\n"), lambda x, i: F.when(~F.array_contains("_cut", i), x)), lambda x: x.isNotNull())
    body = F.when(F.col("_cut").isNull(), F.col("text")).otherwise(F.regexp_replace(F.array_join(kept, "\n"), r"^\n+|\n+$", ""))
    return pages.select("page_id", "text").join(cut, "page_id", "left").select("page_id", body.alias("body"))
