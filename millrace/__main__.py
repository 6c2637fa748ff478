"""The stages from the command line: ``python -m millrace STAGE --input PATH --output PATH ...``.

Each stage reads a folder and writes a finished one; a folder that is finished
is left as it is unless ``--overwrite`` is given.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import session
from millrace.functions import predicates as P
from millrace.operators import stats
from millrace.plans import pipeline
from millrace.sources import readers, sinks, warc

Options = argparse.Namespace
_STAGES: dict[str, tuple[Callable[[SparkSession, Options], DataFrame], tuple[str, ...]]] = {}


def stage(*options: str) -> Callable:
    """Registers a stage under its function's name with the options it takes beside the common ones."""

    def note(f: Callable[[SparkSession, Options], DataFrame]) -> Callable:
        _STAGES[f.__name__.strip("_").replace("_", "-")] = f, options
        return f

    return note


def _parquet(spark: SparkSession, o: Options) -> DataFrame:
    if o.max_files:
        return spark.read.parquet(*readers.first_files(spark, f"{o.input.rstrip('/')}/*.parquet", o.max_files))
    return readers.parquet(spark, o.input, skip_corrupt=True)


@stage("start", "end", "prefix")
def snapshots(spark: SparkSession, o: Options) -> DataFrame:
    """Snapshots of an inclusive range of weeks, from the crawl's list of snapshots."""
    return readers.select_snapshots(readers.snapshot_index(spark, o.input), o.start, o.end, o.prefix)


@stage("prefix")
def archive_urls(spark: SparkSession, o: Options) -> DataFrame:
    """Archive addresses of path lists."""
    return readers.path_lists(spark, o.input, o.prefix)


@stage("lang")
def pages(spark: SparkSession, o: Options) -> DataFrame:
    """Pages of archives in a language; the input is a file, a glob or several by commas."""
    warc.register(spark)
    return pipeline.pages_from_archive(spark.read.format("warc").load(o.input), o.lang)


@stage()
def good_pages(spark: SparkSession, o: Options) -> DataFrame:
    """Pages with a title and a main text in the language."""
    return pipeline.good_pages(_parquet(spark, o))


@stage()
def pairs(spark: SparkSession, o: Options) -> DataFrame:
    """Image and caption pairs of good pages."""
    return pipeline.pairs_of_pages(_parquet(spark, o))


@stage()
def unique_pairs(spark: SparkSession, o: Options) -> DataFrame:
    """Two-key deduplication in the order of files and rows."""
    return pipeline.unique_pairs(readers.with_number(_parquet(spark, o)), "ord").drop("ord")


@stage("least_colors")
def sound_images(spark: SparkSession, o: Options) -> DataFrame:
    """Downloaded images of fair size with enough colours."""
    return pipeline.sound_images(_parquet(spark, o), least_colors=o.least_colors)


@stage("score", "below")
def safe_images(spark: SparkSession, o: Options) -> DataFrame:
    """Images whose safety score is below a bound."""
    return pipeline.safe_images(_parquet(spark, o), o.score, o.below)


@stage()
def hashed_images(spark: SparkSession, o: Options) -> DataFrame:
    """Images with their perceptual hash."""
    return pipeline.hashed_images(_parquet(spark, o))


@stage("max_elements", "error_rate")
def unique_images(spark: SparkSession, o: Options) -> DataFrame:
    """First image of each hash in the order of files and rows; with ``--max-elements`` by Bloom filters."""
    return pipeline.unique_images(readers.with_number(_parquet(spark, o)), "ord", o.max_elements, o.error_rate).drop("ord")


@stage("least")
def similar_pairs(spark: SparkSession, o: Options) -> DataFrame:
    """Pairs of a similarity at a bound or over it."""
    return _parquet(spark, o).filter(P.is_similar("similarity", o.least))


@stage()
def count(spark: SparkSession, o: Options) -> DataFrame:
    """Rows of each file."""
    return stats.rows_per_file(_parquet(spark, o))


@stage("files")
def compact(spark: SparkSession, o: Options) -> DataFrame:
    """The same rows in fewer files."""
    return _parquet(spark, o).repartition(o.files)


_OPTIONS = {
    "start": {"required": True}, "end": {"required": True}, "prefix": {"default": "https://data.commoncrawl.org"}, "lang": {"default": "ja"},
    "least_colors": {"type": int, "default": 32}, "score": {"default": "punsafe"}, "below": {"type": float, "default": 0.1}, "max_elements": {"type": int},
    "error_rate": {"type": float, "default": 0.01}, "least": {"type": float, "default": 0.1}, "files": {"type": int, "default": 1},
}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser("millrace", description=__doc__)
    stages = top.add_subparsers(dest="stage", required=True)
    for name, (f, options) in _STAGES.items():
        one = stages.add_parser(name, help=f.__doc__)
        one.add_argument("--input", required=True)
        one.add_argument("--output", required=True)
        one.add_argument("--overwrite", action="store_true")
        one.add_argument("--max-files", type=int, help="only so many files, the first by name")
        for option in options:
            one.add_argument("--" + option.replace("_", "-"), **_OPTIONS[option])
    return top


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> int:
    """Runs one stage; the number of rows of its output is printed and returned."""
    o = parser().parse_args(arguments)
    spark = spark or SparkSession.builder.appName(f"millrace {o.stage}").getOrCreate()
    session.ship(spark)
    rows = sinks.run_stage(spark, lambda: _STAGES[o.stage][0](spark, o), o.output, o.overwrite).agg(F.count("*")).first()[0]
    print(rows)
    return rows


if __name__ == "__main__":
    main()
