"""Reading HTML: image and caption pairs, main text.

Parsing runs in Arrow batches on the standard library's parser; filter rows
and select columns before, as nothing is pushed past it.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.schemas import struct

#: Elements without content (fixed values).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that hold no main text, and those that end a line (fixed values).
NOT_MAIN = frozenset("script style noscript template nav aside footer header form button select iframe svg table".split())
BLOCK = frozenset("p div section article main ul ol li dl dt dd h1 h2 h3 h4 h5 h6 blockquote pre figure figcaption br hr tr td".split())


class _Figure:
    """An open figure: the text of its first caption, once there is one."""

    def __init__(self):
        self.caption: list[str] | None = None


class PairParser(HTMLParser):
    """Collects every ``img`` with a ``src`` and the figure it stands in.

    An end tag closes up to the nearest open element of its name; what is left
    open ends with the page.  The caption of an image's nearest figure is the
    figure's first ``figcaption`` anywhere below it, before or after the image.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, _Figure | None]] = []
        self.images: list[tuple[str, str, _Figure | None]] = []
        self.captions: list[tuple[int, list[str]]] = []  # depth and text of open figcaptions

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "img":
            given = dict(attrs)  # of an attribute given twice the last counts
            if given.get("src"):
                figure = next((f for _, f in reversed(self.stack) if f), None)
                self.images.append((given["src"], given.get("alt") or "", figure))
        if tag in VOID:
            return
        self.stack.append((tag, _Figure() if tag == "figure" else None))
        if tag == "figcaption":
            text: list[str] = []
            for _, figure in self.stack:
                if figure and figure.caption is None:
                    figure.caption = text
            self.captions.append((len(self.stack), text))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        for depth in range(len(self.stack) - 1, -1, -1):
            if self.stack[depth][0] == tag:
                del self.stack[depth:]
                while self.captions and self.captions[-1][0] > depth:
                    self.captions.pop()
                return

    def handle_data(self, data: str) -> None:
        if self.captions and self.stack[-1][0] not in ("script", "style", "template"):
            for _, text in self.captions:
                text.append(data)

    def pairs(self) -> list[tuple[str, str]]:
        out = []
        for src, alt, figure in self.images:
            caption = "".join(x.strip() for x in figure.caption) if figure and figure.caption else ""
            caption = caption or alt.strip()
            if caption:
                out.append((src, caption))
        return out


def image_captions(html: str | None) -> list[tuple[str, str]]:
    """``src`` and caption of each captioned image in order of the page; none for a page that can't be read."""
    if not html:
        return []
    parser = PairParser()
    try:
        parser.feed(html)
        parser.close()
    except Exception:
        return []
    return parser.pairs()


def extract_pairs(
    pages: DataFrame,
    url_ok: Callable | None = None,
    caption_ok: Callable | None = None,
    id_col: str | None = None,
    carry: tuple[str, ...] = ("title", "text"),
) -> DataFrame:
    """One row per captioned image: ``url, caption, page_title, page_url, text, position`` (and ``id_col``).

    ``carry`` names which of the page's title and text go along; nothing is
    pruned past the parser, so leave out what isn't used.  Pages without an
    image tag don't reach it.

    ``pages`` has ``title, url, text, html``.  Image addresses are joined with
    the page's URL; ``url_ok`` and ``caption_ok`` are predicates on columns
    (see :mod:`millrace.functions.predicates`), None to keep all.  A page with
    null or unreadable html gives no rows.
    """
    from millrace.functions.urls import join_url

    carried = [c for c in (id_col, "url", *carry) if c]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, src, captions, position = [], [], [], []
            for k, html in enumerate(batch.column(len(carried)).to_pylist()):
                for i, (address, caption) in enumerate(image_captions(html)):
                    rows.append(k)
                    src.append(address)
                    captions.append(caption)
                    position.append(i)
            kept = batch.select(carried).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(src, pa.string()), pa.array(captions, pa.string()), pa.array(position, pa.int32())],
                [*carried, "_src", "caption", "position"],
            )

    schema = T.StructType([*(pages.schema[c] for c in carried), *struct("_src STRING, caption STRING, position INT").fields])
    found = pages.select(*carried, "html").filter(F.col("html").rlike("(?i)<img")).mapInArrow(run, schema)
    out = found.select(
        *([id_col] if id_col else []), join_url(F.col("url"), F.col("_src")).alias("_image"), "caption",
        *([F.col("title").alias("page_title")] if "title" in carry else []), F.col("url").alias("page_url"),
        *(["text"] if "text" in carry else []), "position",
    ).withColumnRenamed("_image", "url")
    if url_ok is not None:
        out = out.filter(url_ok("url"))
    if caption_ok is not None:
        out = out.filter(caption_ok("caption"))
    return out


class _TextParser(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.skipped: list[str] = []
        self.parts: list[str] = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if self.skipped:
            if tag == self.skipped[-1] and tag not in VOID:
                self.skipped.append(tag)
        elif tag in NOT_MAIN or tag in ("head", "title"):
            self.skipped.append(tag)
        elif tag in BLOCK:
            self.parts.append("\n")

    def handle_endtag(self, tag: str) -> None:
        if self.skipped:
            if tag == self.skipped[-1]:
                self.skipped.pop()
        elif tag in BLOCK:
            self.parts.append("\n")

    def handle_data(self, data: str) -> None:
        if not self.skipped:
            self.parts.append(data.replace("\n", " "))


_SPACES = re.compile(r"[^\S\n]+")


def main_text(html: str | None) -> str | None:
    """Text of a page outside navigation, forms, tables, scripts and page ends, a line per block; None if there is none.

    Lines that occurred before on the page are left out.
    """
    if not html:
        return None
    parser = _TextParser()
    try:
        parser.feed(html)
        parser.close()
    except Exception:
        return None
    lines = (_SPACES.sub(" ", x).strip() for x in "".join(parser.parts).split("\n"))
    return "\n".join(dict.fromkeys(x for x in lines if x)) or None


def extract_text(df: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    """``df`` with the main text of ``html`` in ``out``, an existing column of the name replaced."""
    @F.pandas_udf(T.StringType())
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(main_text)

    return df.withColumn(out, run.asNondeterministic()(F.col(html)))
