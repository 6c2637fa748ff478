"""ISO weeks and crawl snapshot names."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_monday(year: Column, week: Column) -> Column:
    """Monday of an ISO week; NULL for a week the year doesn't have."""
    first = F.date_trunc("week", F.make_date(year, F.lit(1), F.lit(4))).cast("date")
    monday = F.date_add(first, ((week - 1) * 7).cast("int"))
    # The week's Thursday lies in its year.
    return F.when((week >= 1) & (F.year(F.date_add(monday, 3)) == year), monday)


def snapshot_parts(snapshot_id: Column | str) -> tuple[Column, Column]:
    """Year and week of ``NAME-NAME-YYYY-WW``; NULL unless exactly two whole numbers follow the names."""
    parts = F.slice(F.split(snapshot_id, "-"), 3, 100)
    two = F.size(parts) == 2
    part = lambda i: F.when(two, F.try_element_at(parts, F.lit(i)).try_cast("int"))
    return part(1), part(2)


def parse_snapshot(text: str) -> tuple[datetime.date, int]:
    """Monday and year of ``YYYY-WW``."""
    year, week = map(int, text.split("-"))
    return datetime.date.fromisocalendar(year, week, 1), year


def snapshot_path(prefix: str, year: Column, week: Column) -> Column:
    """Address of a snapshot's list of archive files."""
    return F.format_string(prefix.rstrip("/").replace("%", "%%") + "/crawl-data/CC-MAIN-%d-%02d/warc.paths.gz", year, week)
