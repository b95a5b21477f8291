"""From archives or the lake to stored marts."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from newsmart import commits
from newsmart.sinks import merge_mart, write_mart, write_period
from newsmart.sources import archive_glob, read_archive_lines

from . import marts
from .landing import PARSERS, read_lake

Records = Callable[[str], DataFrame]

# What each mart is made from.
BUILDERS: dict[str, Callable[[Records], DataFrame]] = {
    "querya": lambda records: marts.best_language_counts(records("export"), records("mentions")),
    "queryb2": lambda records: marts.event_mentions(records("export"), records("mentions")),
    "queryctheme": lambda records: marts.theme_tone(records("gkg")),
    "querycperson": lambda records: marts.person_tone(records("gkg")),
    "queryccountry": lambda records: marts.country_tone(records("gkg")),
    "queryd2": lambda records: marts.country_pair_tone(records("gkg")),
    "queryb2rollup": lambda records: marts.event_rollup(
        marts.event_mentions(records("export"), records("mentions"))),
    "queryd2monthly": lambda records: marts.monthly_pairs(marts.country_pair_tone(records("gkg"))),
}


# Marts that come from one scan of the articles.
ITEM_MARTS = {"queryctheme": "theme", "querycperson": "person", "queryccountry": "country"}


def archive_records(spark: SparkSession, base: str, period: str) -> Records:
    """Records parsed from the period's archives, each time they are used."""
    return lambda kind: PARSERS[kind](read_archive_lines(spark, archive_glob(base, period, kind)))


def lake_records(spark: SparkSession, lake: str, period: str) -> Records:
    """Records of the period from the lake: columnar and pruned, so the way to build more than one mart."""
    return lambda kind: read_lake(spark, lake, kind, period)


def store_marts(records: Records, names: list[str], target: str = "", fmt: str = "parquet", mode: str = "overwrite",
                period: str = "", allow_empty: bool = False, **options: str) -> None:
    """Build marts and write each to ``target/<name>``; every format takes every mart.

    With a ``period`` and a file format, each goes to the period's own folder there and replaces only that; with mode
    ``merge`` its rows replace those of equal key instead, whatever period they came with. A table connector needs options
    instead of a target; ``{mart}`` in one stands for the mart's name. Of the item marts, two or more are made from one
    scan of the articles, whose result is kept beside the target until they are written.
    """
    root = target.rstrip("/")
    shared = [name for name in names if name in ITEM_MARTS]
    builders, staging = dict(BUILDERS), ""
    spark = None
    try:
        if len(shared) > 1 and root:
            made = marts.item_tones(records("gkg"))
            spark, staging = made.sparkSession, f"{root}/_staging-{uuid.uuid4().hex}"
            made.write.partitionBy("kind").parquet(staging)
            kept = spark.read.schema(made.schema).parquet(staging)
            for name in shared:
                builders[name] = lambda _, kind=ITEM_MARTS[name]: marts.of_kind(kept, kind)
        for name in names:
            own = {key: value.format(mart=name) for key, value in options.items()}
            place = f"{root}/{name}" if root else ""
            if mode == "merge":
                merge_mart(builders[name](records), name, place)
            elif period and place:
                write_period(builders[name](records), name, place, period, fmt, allow_empty, **own)
            else:
                write_mart(builders[name](records), name, place, fmt, mode, **own)
    finally:
        if staging:
            commits.delete(spark, staging)
