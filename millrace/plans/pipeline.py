"""The stages as functions from DataFrame to DataFrame, and their chain."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import predicates as P
from millrace.functions.html import extract_pairs, extract_text
from millrace.functions.images import Decode, color_count, phash_of
from millrace.functions.text import decode_bytes, is_japanese, title
from millrace.functions.vectors import Head, cosine, head_score
from millrace.operators.dedup import first_seen, first_seen_bloom, greedy_two_key


def pages_from_archive(records: DataFrame, lang: str = "ja") -> DataFrame:
    """``url, html`` of the HTML responses in the language; cheap header tests come first."""
    kept = records.filter(P.is_response("rec_type") & P.is_html_type("content_type"))
    decoded = kept.select("url", decode_bytes("payload").alias("html"))
    return decoded.filter(P.has_text("html")).filter(P.declares_language("html", lang))


def good_pages(pages: DataFrame, is_language: Callable[[str], Column] = is_japanese) -> DataFrame:
    """``title, url, text, html`` of pages with a title and a main text in the language."""
    titled = pages.withColumn("title", title("html")).filter(P.has_text("title"))
    found = extract_text(titled).filter(P.has_text("text"))
    return found.filter(is_language("text")).select("title", "url", "text", "html")


def pairs_of_pages(pages: DataFrame, url_ok=P.is_web_image, caption_ok=P.is_good_caption) -> DataFrame:
    return extract_pairs(pages, url_ok, caption_ok).drop("position")


def unique_pairs(pairs: DataFrame, ord: str) -> DataFrame:
    return greedy_two_key(pairs, "url", "caption", ord)


def sound_images(images: DataFrame, colors: Column | None = None, least_colors: int = 32, decode: Decode | None = None) -> DataFrame:
    """Downloaded images of fair size with enough colours; sizes are tested before any byte is decoded.

    ``colors`` is a column with the count if there is one; else the bytes are
    decoded, and images that can't be read are left out.
    """
    fair = images.filter(P.succeeded("status") & P.large_enough("original_width", "original_height") & P.fair_ratio("original_width", "original_height"))
    counted = fair.withColumn("_colors", color_count("jpg", decode=decode) if colors is None else colors)
    return counted.filter(F.col("_colors") >= least_colors).drop("_colors")


def discarded_by_helper(width: str, height: str, colors: Column | None = None) -> Column:
    """The helper's rule: like the pipeline's, but a ratio of exactly a half is discarded too."""
    keep = P.large_enough(width, height) & P.fair_ratio(width, height, low_included=False)
    return ~(keep & F.coalesce(colors >= 32, F.lit(False))) if colors is not None else ~keep


def safe_images(images: DataFrame, score: Column | str, below: float = 0.1) -> DataFrame:
    """Images with ``punsafe`` from a score column, those at the bound or over and NaN left out."""
    return images.withColumn("punsafe", F.col(score) if isinstance(score, str) else score).filter(P.is_safe("punsafe", below))


def scored_by_head(images: DataFrame, embedding: str, head: Head) -> DataFrame:
    return safe_images(images, head_score(embedding, head))


def hashed_images(images: DataFrame, decode: Decode | None = None) -> DataFrame:
    return images.withColumn("phash", phash_of("jpg", decode)).filter("phash IS NOT NULL")


def unique_images(images: DataFrame, ord: str, capacity: int | None = None, error: float = 0.01) -> DataFrame:
    """First image of each perceptual hash; with ``capacity`` by Bloom filters."""
    return first_seen(images, "phash", ord) if capacity is None else first_seen_bloom(images, "phash", ord, capacity, error)


def similar_pairs(images: DataFrame, image_embedding: str, text_embedding: str, least: float = 0.1) -> DataFrame:
    return images.withColumn("similarity", cosine(image_embedding, text_embedding)).filter(P.is_similar("similarity", least))
