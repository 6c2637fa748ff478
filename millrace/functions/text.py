"""Text expressions that stay in the JVM, and byte decoding."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Encodings tried after UTF-8, most telling first (names of codecs, fixed values).
FALLBACK_ENCODINGS = ("euc_jp", "cp932", "cp1252")


def strip(text: Column | str) -> Column:
    """Unicode white space off both ends, like Python's ``strip``."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def caption(figcaption: Column, alt: Column) -> Column:
    """The figure's caption unless it is empty, else the stripped ``alt``; NULL if both are."""
    return F.coalesce(F.nullif(figcaption, F.lit("")), F.nullif(strip(alt), F.lit("")))


def _character(code: Column) -> Column:
    """The character of a code point; NULL for those that are none."""
    fine = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    return F.when(fine, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))


def unescape(text: Column) -> Column:
    """Text with the usual named character references and all numeric ones resolved."""

    def part(x: Column, i: Column) -> Column:
        rest = F.substr(x, F.instr(x, ";") + 1)
        decimal = _character(F.regexp_extract(x, "^([0-9]{1,7});", 1).try_cast("bigint"))
        hexadecimal = _character(F.conv(F.regexp_extract(x, "^[xX]([0-9A-Fa-f]{1,6});", 1), 16, 10).try_cast("bigint"))
        return F.when(i == 0, x).otherwise(F.coalesce(F.concat(F.coalesce(decimal, hexadecimal), rest), F.concat(F.lit("&#"), x)))

    found = F.when(F.contains(text, F.lit("&#")), F.array_join(F.transform(F.split(text, "&#"), part), "")).otherwise(text)
    for name, char in (("&nbsp;", "\u00a0"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")):
        found = F.replace(found, F.lit(name), F.lit(char))
    return found


#: Where a page says its title, best first.
TITLE_PATTERNS = (
    r"(?is)<title[^>]*>(.*?)</title>",
    r"""(?is)<meta\s[^>]*property=["']?og:title["']?\s[^>]*content=["']([^"'<>]*)["']""",
    r"""(?is)<meta\s[^>]*content=["']([^"'<>]*)["'][^>]*\sproperty=["']?og:title["']?""",
    r"(?is)<h1[^>]*>([^<]*)</h1>",
)


def title(html: Column | str) -> Column:
    """The page's ``<title>``, else its og:title, else its first plain ``<h1>``; character references resolved; NULL if all are missing or empty."""
    return F.coalesce(*[F.nullif(strip(unescape(F.regexp_extract(html, pattern, 1))), F.lit("")) for pattern in TITLE_PATTERNS])


def japanese_share(text: Column | str) -> Column:
    """Share of kana and kanji among letters; 0 for a text without letters, NULL for NULL."""
    japanese = F.regexp_count(text, F.lit(r"[\x{3041}-\x{30FF}\x{4E00}-\x{9FFF}\x{FF66}-\x{FF9D}]"))
    letters = F.regexp_count(text, F.lit(r"[\x{3041}-\x{30FF}\x{4E00}-\x{9FFF}\x{FF66}-\x{FF9D}A-Za-z\x{C0}-\x{24F}\x{400}-\x{4FF}\x{AC00}-\x{D7A3}]"))
    return F.when(letters > 0, japanese / letters).otherwise(F.when(F.col(text).isNotNull() if isinstance(text, str) else text.isNotNull(), F.lit(0.0)))


def is_japanese(text: Column | str, least: float = 0.3) -> Column:
    """Whether a text is Japanese: enough kana and kanji, some kana among them.

    The default detector; it needs no model.  NULL is not Japanese.
    """
    kana = F.regexp_count(text, F.lit(r"[\x{3041}-\x{30FF}\x{FF66}-\x{FF9D}]")) > 0
    return F.coalesce((japanese_share(text) >= least) & kana, F.lit(False))


def detected(text: Column | str, detect: Callable[[list[str]], list[str | None]]) -> Column:
    """The language a detector gives each text, in Arrow batches; NULL for NULL and where it gives none.

    ``detect`` takes a list of texts, so that a fast detector can work on many
    at once; it is sent to the executors with the function.
    """

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            there = batch.notna().to_numpy()
            out = np.full(len(batch), None, object)
            if there.any():
                out[there] = detect(batch[there].tolist())
            yield pd.Series(out, dtype=object)

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, T.StringType())(text)


def is_detected(detect: Callable[[list[str]], list[str | None]], language: str = "ja") -> Callable[[str], Column]:
    """A language test by a detector, for use where :func:`is_japanese` is the default."""
    return lambda text: F.coalesce(detected(text, detect) == language, F.lit(False))


def decode_bytes(data: Column | str, encodings: tuple[str, ...] = FALLBACK_ENCODINGS) -> Column:
    """Text of bytes: strict UTF-8, else the first of ``encodings`` that reads them; NULL if none does."""

    @F.pandas_udf(T.StringType())
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        def one(raw: bytes | None) -> str | None:
            for name in ("utf-8", *encodings) if raw is not None else ():
                try:
                    return bytes(raw).decode(name)
                except UnicodeDecodeError:
                    pass
            return None

        for batch in batches:
            yield batch.map(one)

    return run(data)


def basename(path: Column | str, suffix: str | None = None, replacement: str = "") -> Column:
    """Last part of a path, with one suffix swapped."""
    name = F.element_at(F.split(path, "/"), -1)
    return F.replace(name, F.lit(suffix), F.lit(replacement)) if suffix else name
