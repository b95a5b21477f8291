"""Articles → tone per item or pair of countries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from newsmart.functions import first_tone, item_date_parts

from .once import once


def tone_by_item(gkg: DataFrame, listing: Column, item: str, skip_blank: bool = False,
                 calendar_months: bool = False) -> DataFrame:
    """Articles and mean tone per (date, source, item); articles without a numeric tone are left out.

    Only date, source, tone and the list pass the explode, and the counts are combined before the one shuffle,
    so a blank or ever-present item costs no more than a rare one.
    """
    dated = gkg.select(
        item_date_parts(F.col("DATE"))["date"].alias("date"),
        F.col("SourceCommonName").alias("source"),
        once(listing).alias("listing"),
        first_tone("V2Tone", "float").alias("tone"),
    ).dropna(subset=["tone"])
    exploded = dated.select("date", "source", "tone", F.explode("listing").alias(item))
    if skip_blank:
        exploded = exploded.where(F.col(item) != "")
    parts = item_date_parts(F.col("date"), calendar_months)
    return (
        exploded.groupBy("date", "source", item)
        .agg(F.count("*").alias("nbarticle"), F.avg("tone").alias("tonemean"))
        .select("date", *(parts[name].alias(name) for name in ("year", "month", "day")),
                "source", item, "nbarticle", "tonemean")
    )


def tones_by_kind(gkg: DataFrame, listings: dict[str, Column], calendar_months: bool = False) -> DataFrame:
    """(kind, date, year, month, day, source, item, nbarticle, tonemean) for several item lists of an article in one scan and
    one aggregate, each list's rows as ``tone_by_item`` gives them."""
    tagged = F.array(*(F.struct(F.lit(kind).alias("kind"), listing.alias("listing")) for kind, listing in listings.items()))
    dated = gkg.select(
        item_date_parts(F.col("DATE"))["date"].alias("date"),
        F.col("SourceCommonName").alias("source"),
        F.explode(tagged).alias("tagged"),
        first_tone("V2Tone", "float").alias("tone"),
    ).dropna(subset=["tone"])
    exploded = dated.select("date", "source", "tone", "tagged.kind", F.explode("tagged.listing").alias("item"))
    parts = item_date_parts(F.col("date"), calendar_months)
    return (
        exploded.groupBy("kind", "date", "source", "item")
        .agg(F.count("*").alias("nbarticle"), F.avg("tone").alias("tonemean"))
        .select("kind", "date", *(parts[name].alias(name) for name in ("year", "month", "day")),
                "source", "item", "nbarticle", "tonemean")
    )


def explode_pairs(df: DataFrame, countries: str) -> DataFrame:
    """One row per pair of a row's distinct countries, each pair sorted; replaces the list column.

    Two explodes in a row: a task holds one country list at a time, never the quadratic list of its pairs.
    """
    others = [name for name in df.columns if name != countries]
    return (
        df.where(F.size(countries) > 1)
        .select(*others, countries, F.posexplode(countries).alias("at", "one"))
        .select(*others, "one", F.explode(F.slice(countries, F.col("at") + 2, F.size(countries))).alias("other"))
        .select(*others, F.least("one", "other").alias("country1"), F.greatest("one", "other").alias("country2"))
    )
