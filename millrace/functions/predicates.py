"""Row predicates as column expressions.

Each takes columns or column names and gives a BOOLEAN column; unless said
otherwise a NULL input gives FALSE, so a filter and its negation cover all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.urls import host

# Code points that are emoji by themselves, from the Unicode emoji data (fixed values).
EMOJI = (
    "A9 AE 203C 2049 2122 2139 2194-2199 21A9-21AA 231A-231B 2328 23CF 23E9-23F3 23F8-23FA 24C2 25AA-25AB 25B6 25C0 25FB-25FE 2600-2604 260E 2611 "
    "2614-2615 2618 261D 2620 2622-2623 2626 262A 262E-262F 2638-263A 2640 2642 2648-2653 265F-2660 2663 2665-2666 2668 267B 267E-267F 2692-2697 2699 "
    "269B-269C 26A0-26A1 26A7 26AA-26AB 26B0-26B1 26BD-26BE 26C4-26C5 26C8 26CE-26CF 26D1 26D3-26D4 26E9-26EA 26F0-26F5 26F7-26FA 26FD 2702 2705 "
    "2708-270D 270F 2712 2714 2716 271D 2721 2728 2733-2734 2744 2747 274C 274E 2753-2755 2757 2763-2764 2795-2797 27A1 27B0 27BF 2934-2935 2B05-2B07 "
    "2B1B-2B1C 2B50 2B55 3030 303D 3297 3299 1F004 1F0CF 1F170-1F171 1F17E-1F17F 1F18E 1F191-1F19A 1F201-1F202 1F21A 1F22F 1F232-1F23A 1F250-1F251 "
    "1F300-1F321 1F324-1F393 1F396-1F397 1F399-1F39B 1F39E-1F3F0 1F3F3-1F3F5 1F3F7-1F4FD 1F4FF-1F53D 1F549-1F54E 1F550-1F567 1F56F-1F570 1F573-1F57A "
    "1F587 1F58A-1F58D 1F590 1F595-1F596 1F5A4-1F5A5 1F5A8 1F5B1-1F5B2 1F5BC 1F5C2-1F5C4 1F5D1-1F5D3 1F5DC-1F5DE 1F5E1 1F5E3 1F5E8 1F5EF 1F5F3 "
    "1F5FA-1F64F 1F680-1F6C5 1F6CB-1F6D2 1F6D5-1F6D7 1F6DC-1F6E5 1F6E9 1F6EB-1F6EC 1F6F0 1F6F3-1F6FC 1F7E0-1F7EB 1F7F0 1F90C-1F93A 1F93C-1F945 "
    "1F947-1F9FF 1FA70-1FA7C 1FA80-1FA89 1FA8F-1FAC6 1FACE-1FADC 1FADF-1FAE9 1FAF0-1FAF8"
)
EMOJI_CLASS = "[" + "".join("-".join(rf"\x{{{end}}}" for end in part.split("-")) for part in EMOJI.split()) + "]"


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _false(x: Column) -> Column:
    return F.coalesce(x, F.lit(False))


def _known(condition: Column, *inputs: Column | str) -> Column:
    """The condition, and FALSE where an input is null; unlike ``coalesce`` it reaches the scan as a filter."""
    for x in inputs:
        condition = _col(x).isNotNull() & condition
    return condition


def has_text(text: Column | str) -> Column:
    """Neither null nor empty."""
    return _known(_col(text) != "", text)


def is_response(rec_type: Column | str) -> Column:
    return _known(_col(rec_type) == "response", rec_type)


def is_html_type(content_type: Column | str) -> Column:
    """The content type contains ``html``, in this case; a missing one doesn't."""
    return _known(F.contains(_col(content_type), F.lit("html")), content_type)


def declares_language(html: Column | str, lang: str = "ja") -> Column:
    """The ``html`` tag's ``lang`` begins with ``lang``: a prefix match, any case, quotes optional."""
    return _false(_col(html).rlike(rf"(?i)<html[^>]*lang=[\"']?{lang}[\"']?"))


def is_web_image(url: Column | str) -> Column:
    """Default image URL policy: http or https with a host."""
    return _false(_col(url).rlike(r"(?i)^\s*https?://") & host(_col(url)).isNotNull())


def succeeded(status: Column | str) -> Column:
    return _known(_col(status) == "success", status)


def large_enough(width: Column | str, height: Column | str, least: int = 150) -> Column:
    return _known((_col(width) >= least) & (_col(height) >= least), width, height)


def fair_ratio(width: Column | str, height: Column | str, low: float = 0.5, high: float = 2.0, low_included: bool = True) -> Column:
    """Width over height within bounds; the helper's rule leaves the lower bound out."""
    ratio = _col(width) / F.nullif(_col(height), F.lit(0))
    return _false((ratio >= low if low_included else ratio > low) & (ratio <= high))


def is_safe(punsafe: Column | str, below: float = 0.1) -> Column:
    """Strictly below; NaN isn't."""
    return _known((_col(punsafe) < below) & ~F.isnan(_col(punsafe)), punsafe)


def is_similar(similarity: Column | str, least: float = 0.1) -> Column:
    """At least; NaN isn't."""
    return _known((_col(similarity) >= least) & ~F.isnan(_col(similarity)), similarity)


def first_word(text: Column | str, words: list[str]) -> Column:
    """The first word of the list that the text contains, by order of the list; NULL if none."""
    if not words:
        return F.lit(None).cast("string")
    return F.coalesce(*[F.when(F.contains(_col(text), F.lit(w)), F.lit(w)) for w in words])


def contains_any(text: Column | str, words: list[str], strict: bool = False) -> Column:
    """Any listed substring.  An empty entry matches all texts if ``strict``, else it is left out."""
    listed = words if strict else [w for w in words if w]
    if "" in listed:
        return _col(text).isNotNull()
    return _false(first_word(text, listed).isNotNull())


def repeats_characters(text: Column | str, n: int = 4) -> Column:
    """Some character stands ``n`` times in a row, unless the only such run ends the text
    and its character occurs nowhere before it."""
    if n <= 1:
        return _false(F.char_length(_col(text)) > n)
    return _false(_col(text).rlike(rf"(?s)(.)\1{{{n - 1}}}.|(.).*\2{{{n}}}\z"))


def many_newlines(text: Column | str, n: int = 3) -> Column:
    return _false(F.regexp_count(_col(text), F.lit("\n")) > n)


def many_emojis(text: Column | str, n: int = 3) -> Column:
    """More than ``n`` single code points that are emoji."""
    return _false(F.regexp_count(_col(text), F.lit(EMOJI_CLASS)) > n)


def is_good_caption(text: Column | str, words: list[str] | None = None) -> Column:
    """Default caption policy: has text and none of the listed words, runs of 4, over 3 newlines or emojis."""
    bad = repeats_characters(text) | many_newlines(text) | many_emojis(text)
    if words:
        bad = bad | contains_any(text, words)
    return has_text(text) & ~bad


def on_listed_host(df: DataFrame, url: str, domains: DataFrame, keep: bool = False) -> DataFrame:
    """Rows whose host is exactly in ``domains.domain`` (``keep``), or those whose isn't.

    Hosts are in lower case, the list as it is; parents of a domain don't
    match.  The list is deduplicated; Spark broadcasts it if its size allows.
    A row without a host is on no list.
    """
    listed = domains.select(F.col("domain").alias("_domain")).filter("_domain IS NOT NULL").distinct()
    return df.join(listed, host(df[url]) == listed["_domain"], "left_semi" if keep else "left_anti")
