"""The registered queries: library calls over feed lines made from the test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from newsmart import functions as fn
from newsmart import operators as op
from newsmart import plans, sinks, sources

from . import feed, relations

# What the parametrised queries ask for.
DAY = "19980315"
COUNTRY = "NATION_4"
SERIES = ("1998-01-01", "1998-02-01")
PAIR = ("NATION_1", "NATION_14")
THEME = "T3"
PERIOD = "1998"
MANIFEST_PERIOD = "199803"
WATCHLIST = ("NATION_0", "NATION_3", "NATION_7", "NATION_11", "NATION_19", "NATION_24")
ALIASES = (
    ("NATION_0", "NATION_1"), ("NATION_11", "NATION_3"), ("NATION_12", "NATION_2"), ("NATION_10", "NATION_9"),
    ("NATION_15", "NATION_5"), ("NATION_20", "NATION_8"), ("", "NATION_6"),
)
MONTHS = tuple(range(1, 13))

Query = Callable[[SparkSession, str], DataFrame]


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.parse_events(feed.event_lines(spark, sf_dir))


def _mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.parse_mentions(feed.mention_lines(spark, sf_dir))


def _gkg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.parse_gkg(feed.gkg_lines(spark, sf_dir))


def _mart_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.best_language_counts(_events(spark, sf_dir), _mentions(spark, sf_dir))


def _mart_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.event_mentions(_events(spark, sf_dir), _mentions(spark, sf_dir))


def _mart_d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.country_pair_tone(_gkg(spark, sf_dir))


def _day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.day_slice(_mart_a(spark, sf_dir), DAY)


def _parsed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).withColumn("DATEADDED", F.col("DATEADDED").cast("bigint"))


def _reject_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = {"export": feed.event_lines, "mentions": feed.mention_lines, "gkg": feed.gkg_lines}
    return reduce(DataFrame.unionAll, (
        op.rejected_lines(make(spark, sf_dir), kind).groupBy("n_fields").agg(F.count("*").alias("lines"))
        .select(F.lit(kind).alias("kind"), "n_fields", "lines")
        for kind, make in lines.items()))


def _lenient_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = F.col("l_partkey")
    text = (
        F.when(part % 6 == 0, "")
        .when(part % 6 == 1, F.concat(F.lit(" "), part))
        .when(part % 6 == 2, F.col("l_quantity").cast("string"))
        .when(part % 6 == 3, (part + 30000000000).cast("string"))
        .when(part % 6 == 4, F.concat(F.lit("+"), part))
        .otherwise(F.concat(F.lit("-"), part))
    )
    texts = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", "l_partkey", text.alias("text"))
    return texts.select(
        "l_orderkey", "l_linenumber", "l_partkey", fn.int_or_zero("text").alias("as_int"),
        fn.long_or_zero("text").alias("as_long"), fn.double_or_zero("text").alias("as_double"))


def _source_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mentions(spark, sf_dir).groupBy(
        fn.source_language(F.col("MentionDocTranslationInfo")).alias("language")).agg(F.count("*").alias("mentions"))


def _date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = fn.date_parts(F.col("SQLDATE"))
    return _events(spark, sf_dir).groupBy(*(part.alias(name) for name, part in parts.items())).agg(
        F.count("*").alias("events"))


def _tone_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gkg(spark, sf_dir).select(
        "GKGRECORDID", fn.first_tone("V2Tone", "double").alias("tone"),
        fn.first_tone("V2Tone", "float").cast("double").alias("tone_float"))


def _location_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gkg(spark, sf_dir).select(
        "GKGRECORDID", op.once(fn.mentioned_countries(F.col("V2Locations"))).alias("countries")).select(
        "GKGRECORDID", F.posexplode("countries").alias("position", "country"))


def _location_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    countries = _gkg(spark, sf_dir).select(
        "GKGRECORDID", op.once(fn.mentioned_countries(F.col("V2Locations"))).alias("countries"))
    return op.explode_pairs(countries, "countries")


def _period_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _events(spark, sf_dir).where(fn.in_period(F.col("SQLDATE"), PERIOD))
        .groupBy("SQLDATE", "ActionGeo_CountryCode").agg(F.count("*").alias("events")))


def _sized(manifest: DataFrame) -> DataFrame:
    return manifest.select(F.col("size").cast("bigint").alias("size"), "url", "name")


def _manifest_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sized(sources.select_period(feed.manifest(spark, sf_dir), MANIFEST_PERIOD))


def _manifest_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = sources.union_manifests(feed.manifest(spark, sf_dir), feed.translated_manifest(spark, sf_dir))
    return _sized(sources.select_period(both, ""))


def _landing_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = sources.select_period(feed.manifest(spark, sf_dir), "")
    return plans.reconcile(wanted, feed.arrived_files(spark, sf_dir)).drop("url")


def _monthly_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The roll-up from partial sums of each day, added up."""
    daily = _mart_d(spark, sf_dir)
    return plans.monthly_from_states(plans.pair_state(daily.where("day < '16'")).unionAll(
        plans.pair_state(daily.where("NOT day < '16' OR day IS NULL"))))


def _mart_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    gkg = _gkg(spark, sf_dir)
    return plans.mart_counts({
        "querya": _mart_a(spark, sf_dir), "queryb2": _mart_b(spark, sf_dir), "queryd2": _mart_d(spark, sf_dir),
        "queryctheme": plans.theme_tone(gkg), "querycperson": plans.person_tone(gkg),
        "queryccountry": plans.country_tone(gkg)})


def _choropleth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.ranked_from_second(_day(spark, sf_dir)).select("country", F.col("count").alias("number_events"))


def _pair_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = sinks.to_mart_schema(_mart_d(spark, sf_dir), "queryd2")
    return plans.watchlist_grid(stored, WATCHLIST, ALIASES, MONTHS)


QUERIES: dict[str, Query] = {
    # records and scalar functions
    "parse_events": _parsed_events,
    "parse_mentions": _mentions,
    "parse_gkg": _gkg,
    "reject_counts": _reject_counts,
    "lenient_cast": _lenient_cast,
    "source_language": _source_language,
    "date_parts": _date_parts,
    "tone_value": _tone_value,
    "location_countries": _location_countries,
    "location_pairs": _location_pairs,
    # sources
    "period_prune": _period_prune,
    "manifest_filter": _manifest_filter,
    "manifest_union": _manifest_union,
    "landing_reconcile": _landing_reconcile,
    # marts
    "best_mention": lambda spark, d: op.best_mention(_mentions(spark, d)).drop("MentionDocTranslationInfo"),
    "a_language_counts": _mart_a,
    "b_event_mentions": _mart_b,
    "b_rollup": lambda spark, d: plans.event_rollup(_mart_b(spark, d)),
    "c_theme": lambda spark, d: plans.theme_tone(_gkg(spark, d)),
    "c_person": lambda spark, d: plans.person_tone(_gkg(spark, d)),
    "c_country": lambda spark, d: plans.country_tone(_gkg(spark, d)),
    "c_items": lambda spark, d: plans.item_tones(_gkg(spark, d)),
    "d_country_pairs": _mart_d,
    "d_monthly": lambda spark, d: plans.monthly_pairs(_mart_d(spark, d)),
    "d_monthly_states": _monthly_states,
    "mart_counts": _mart_counts,
    "mart_schema": lambda spark, d: sinks.to_mart_schema(_mart_d(spark, d), "queryd2").withColumn(
        "mean_tone", F.col("mean_tone").cast("double")),
    "collapse_to_key": lambda spark, d: op.collapse_to_key(_mart_a(spark, d), ["sqldate", "country", "count"]),
    # serving
    "serve_a_day": _day,
    "serve_a_topk": lambda spark, d: plans.ranked(_day(spark, d), 10),
    "serve_a_topk_skip": lambda spark, d: plans.ranked_from_second(_day(spark, d), 5),
    "serve_a_choropleth": _choropleth,
    "serve_a_country": lambda spark, d: plans.rows_of_country(_mart_a(spark, d), COUNTRY),
    "serve_a_series": lambda spark, d: plans.country_series(_mart_a(spark, d), COUNTRY, *SERIES).withColumn(
        "day", F.col("day").cast("string")),
    "serve_b_country": lambda spark, d: plans.rows_of_country(_mart_b(spark, d), COUNTRY),
    "serve_c_item": lambda spark, d: plans.rows_of_item(plans.theme_tone(_gkg(spark, d)), "theme", THEME),
    "serve_d_pair": lambda spark, d: plans.rows_of_pair(_mart_d(spark, d), *PAIR),
    "d_monthly_top": lambda spark, d: plans.monthly_leaders(_mart_d(spark, d), ALIASES),
    "pair_exclude_alias": lambda spark, d: op.exclude_pairs(_mart_d(spark, d), ALIASES),
    "pair_watchlist": lambda spark, d: op.keep_watchlist(_mart_d(spark, d), WATCHLIST),
    "pair_grid": _pair_grid,
    "sql_events_per_day": lambda spark, d: plans.events_per_day(_events(spark, d)),
    "sql_events_sorted": lambda spark, d: plans.events_sorted(_events(spark, d)),
}


def expected_sql() -> dict[str, str]:
    return relations.expected(
        day=DAY, country=COUNTRY, series=SERIES, pair=PAIR, theme=THEME, period=PERIOD, watchlist=WATCHLIST,
        excluded=ALIASES, months=MONTHS, manifest_period=MANIFEST_PERIOD)
