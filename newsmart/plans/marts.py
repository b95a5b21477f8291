"""The analytical marts. Columns carry their mart names; ``sinks.to_mart_schema`` gives them their stored types."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from newsmart.functions import date_parts, exact_mean, first_tone, items, mentioned_countries
from newsmart.operators import best_mention, explode_pairs, once, repeat_rows, tallied_events, tone_by_item, \
    tones_by_kind


def best_language_counts(events: DataFrame, mentions: DataFrame) -> DataFrame:
    """Mart A: events per (day, country, language of the event's best mention).

    The language is null for an event nobody mentions and "" for a source in the feed's own language. Events are
    counted per (id, day, country) before the join, so that an id shared by many of them is one row per day and
    country there.
    """
    counted = events.groupBy("GLOBALEVENTID", "SQLDATE", "ActionGeo_CountryCode").agg(F.count("*").alias("n"))
    best = best_mention(mentions, ("SRCLC",))
    return (
        counted.join(best, "GLOBALEVENTID", "left")
        .groupBy(
            F.col("SQLDATE").alias("sqldate"),
            F.col("ActionGeo_CountryCode").alias("country"),
            F.col("SRCLC").alias("language"),
        )
        .agg(F.sum("n").alias("count"))
    )


def event_mentions(events: DataFrame, mentions: DataFrame) -> DataFrame:
    """Mart B: every event with its number of mentions.

    ``count`` is the row count of events ⟕ mentions per event id: 1 for an event without mentions, and multiplied
    for an id that occurs more than once. ``true_mentions`` is the plain number, 0 included. Copies of an event row
    are counted first and written back last, so no join or window meets them.
    """
    tallied = tallied_events(events, mentions, ["SQLDATE", "ActionGeo_CountryCode", "Year"])
    parts = date_parts(F.col("SQLDATE"))
    return repeat_rows(tallied, "copies").select(
        F.col("GLOBALEVENTID").alias("globaleventid"), F.col("SQLDATE").alias("sqldate"), "count", "true_mentions",
        F.col("ActionGeo_CountryCode").alias("country"), F.col("Year").alias("year"),
        parts["month"].alias("month"), parts["day"].alias("day"),
    )


def event_rollup(mart_b: DataFrame) -> DataFrame:
    """Mart B per country by day, month and year; ``level`` says which.

    Days are summed first, and only the small daily result is expanded into the three levels.
    """
    daily = mart_b.groupBy("country", "year", "month", "day").agg(
        F.count("*").alias("events"), F.sum("count").alias("mentions"))
    country, year, month, day = (F.col(name) for name in ("country", "year", "month", "day"))
    return (
        daily.groupingSets(
            [[country, year, month, day], [country, year, month], [country, year]], country, year, month, day)
        .agg(
            F.sum("events").alias("events"),
            F.sum("mentions").alias("mentions"),
            F.element_at(F.array(F.lit("day"), F.lit("month"), F.lit("year")),
                         F.grouping("month") + F.grouping("day") + 1).alias("level"),
        )
    )


def theme_tone(gkg: DataFrame, skip_blank: bool = False, calendar_months: bool = False) -> DataFrame:
    """Mart C by theme."""
    return tone_by_item(gkg, items(F.col("Themes")), "theme", skip_blank, calendar_months)


def person_tone(gkg: DataFrame, skip_blank: bool = False, calendar_months: bool = False) -> DataFrame:
    """Mart C by person."""
    return tone_by_item(gkg, items(F.col("Persons")), "person", skip_blank, calendar_months)


def country_tone(gkg: DataFrame, calendar_months: bool = False) -> DataFrame:
    """Mart C by country; an article counts once per country it mentions."""
    return tone_by_item(gkg, mentioned_countries(F.col("V2Locations")), "country", False, calendar_months)


def item_tones(gkg: DataFrame, calendar_months: bool = False) -> DataFrame:
    """Marts C by theme, person and country from one scan of the articles; ``kind`` says which a row is of."""
    return tones_by_kind(gkg, {
        "theme": items(F.col("Themes")), "person": items(F.col("Persons")),
        "country": mentioned_countries(F.col("V2Locations"))}, calendar_months)


def of_kind(item_rows: DataFrame, kind: str) -> DataFrame:
    """One of the marts in ``item_tones``, with its own columns."""
    return item_rows.where(F.col("kind") == kind).withColumnRenamed("item", kind).drop("kind")


def country_pair_tone(gkg: DataFrame) -> DataFrame:
    """Mart D: mean tone and number of articles with a tone, per country pair and day.

    ``tone_sum`` comes along so that coarser means can be weighted.
    """
    articles = gkg.select(
        F.substring(F.col("DATE").cast("string"), 1, 8).alias("date"),
        first_tone("V2Tone", "double").alias("tone"),
        once(mentioned_countries(F.col("V2Locations"))).alias("countries"),
    )
    parts = date_parts(F.col("date"))
    return (
        explode_pairs(articles, "countries")
        .groupBy("country1", "country2", "date")
        .agg(F.avg("tone").alias("mean_tone"), F.count("tone").alias("n_articles"), F.sum("tone").alias("tone_sum"))
        .select(*(parts[name].alias(name) for name in ("day", "month", "year")),
                "n_articles", "mean_tone", "tone_sum", "country1", "country2")
    )


def monthly_pairs(mart_d: DataFrame) -> DataFrame:
    """Mart D per month, the same month of all years together; the mean is over days, each counting alike, and does
    not depend on the order of the days.

    With ``tone_sum`` present, ``weighted_tone`` is the mean over articles.
    """
    measures = [exact_mean("mean_tone").alias("mean_tone"), F.sum("n_articles").alias("n_articles")]
    if "tone_sum" in mart_d.columns:
        measures.append(F.try_divide(F.sum("tone_sum"), F.sum("n_articles")).alias("weighted_tone"))
    return mart_d.groupBy("country1", "country2", "month").agg(*measures)


def pair_state(mart_d: DataFrame) -> DataFrame:
    """What ``monthly_pairs`` needs of some days of mart D, in a form that adds up: per pair and month the sum of daily means
    as a decimal, that of means that are none (see ``exact_mean``), the days that have a mean, and the articles."""
    value = F.col("mean_tone").cast("double")
    plain = F.abs(value) < 1e20
    return mart_d.groupBy("country1", "country2", "month").agg(
        F.sum(F.when(plain, value).try_cast("decimal(38,12)")).alias("means"),
        F.sum(F.when(value.isNotNull() & ~plain, value)).alias("odd_means"), F.count(value).alias("days"),
        F.sum("n_articles").cast("long").alias("n_articles"))


def monthly_from_states(states: DataFrame) -> DataFrame:
    """``monthly_pairs`` of all days whose ``pair_state`` rows are in ``states``."""
    means = F.coalesce(F.sum("odd_means"), F.sum("means").cast("double"))
    return states.groupBy("country1", "country2", "month").agg(
        F.try_divide(means, F.sum("days")).alias("mean_tone"), F.sum("n_articles").alias("n_articles"))


def mart_counts(marts: dict[str, DataFrame]) -> DataFrame:
    """Rows of each mart."""
    return reduce(DataFrame.unionAll, (
        df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("mart"), "rows") for name, df in marts.items()))
