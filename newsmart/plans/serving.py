"""Queries on the marts. Ties are broken by the remaining columns, so results are the same on every run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from newsmart.functions import feed_day
from newsmart.operators import exclude_pairs, keep_watchlist, month_grid, without_top_row
from newsmart.operators.filters import ALIAS_PAIRS, WATCHLIST

from .marts import monthly_pairs

_BY_COUNT = ("count", "country", "language")


def _order(first: str, *rest: str) -> list[Column]:
    return [F.desc_nulls_last(first), *(F.asc_nulls_first(name) for name in rest)]


def day_slice(mart_a: DataFrame, day: str) -> DataFrame:
    return mart_a.where(F.col("sqldate") == day)


def _first(df: DataFrame, limit: int | None) -> DataFrame:
    return df if limit is None else df.limit(limit)


def ranked(day_rows: DataFrame, k: int) -> DataFrame:
    """The k largest (country, language) rows of a day."""
    return day_rows.orderBy(*_order(*_BY_COUNT)).limit(k)


def ranked_from_second(day_rows: DataFrame, k: int | None = None) -> DataFrame:
    """Rows of a day without the largest, which dwarfs the others on a map; the next ``k``, or all."""
    if k is not None:
        return day_rows.orderBy(*_order(*_BY_COUNT)).offset(1).limit(k)
    return without_top_row(day_rows, _order(*_BY_COUNT), ["sqldate", "country", "language"])


def rows_of_country(mart: DataFrame, country: str, limit: int | None = None) -> DataFrame:
    """One country's rows of mart A or B; mart B's by number of mentions, and the first ``limit`` of them."""
    mine = mart.where(F.col("country") == country)
    return _first(
        mine.orderBy(*_order("count", "globaleventid", "sqldate")) if "globaleventid" in mart.columns else mine, limit)


def country_series(mart_a: DataFrame, country: str, start: str, end: str) -> DataFrame:
    """One country's rows dated in [start, end), ISO dates.

    The bounds are also put to the stored yyyyMMdd value, number or text, so that a scan can skip what lies outside.
    """
    stored = F.col("sqldate")
    low, high = (bound.replace("-", "") for bound in (start, end))
    return (
        rows_of_country(mart_a, country)
        .where((stored >= low) & (stored < high))
        .withColumn("day", feed_day(F.col("sqldate")))
        .where((F.col("day") >= F.lit(start).cast("date")) & (F.col("day") < F.lit(end).cast("date")))
    )


def rows_of_item(mart_c: DataFrame, item: str, name: str, limit: int | None = None) -> DataFrame:
    """One theme's, person's or country's rows by number of articles."""
    return _first(mart_c.where(F.col(item) == name).orderBy(*_order("nbarticle", "date", "source")), limit)


def rows_of_pair(mart_d: DataFrame, country1: str, country2: str, limit: int | None = None) -> DataFrame:
    """One pair's days, best mean tone first."""
    return _first(mart_d.where((F.col("country1") == country1) & (F.col("country2") == country2)).orderBy(
        F.desc_nulls_last("mean_tone"), F.desc_nulls_last("n_articles"), "year", "month", "day"), limit)


def monthly_leaders(mart_d: DataFrame, excluded: tuple[tuple[str, str], ...] = ALIAS_PAIRS) -> DataFrame:
    """Monthly pairs by number of articles, without pairs that name one country twice."""
    return monthly_pairs(exclude_pairs(mart_d, excluded)).orderBy(
        *_order("n_articles", "country1", "country2", "month"))


def watchlist_grid(mart_d: DataFrame, watchlist: tuple[str, ...] = WATCHLIST,
                   excluded: tuple[tuple[str, str], ...] = ALIAS_PAIRS,
                   months: tuple[int, ...] | None = None) -> DataFrame:
    """The watch list's pairs with tone bucket, relative size, mean tone and articles for each month.

    Without ``months`` they are the watched pairs' own, of which there are at most twelve.
    """
    watched = keep_watchlist(exclude_pairs(mart_d, excluded), watchlist)
    monthly = monthly_pairs(watched.withColumn("month", F.col("month").cast("int")))
    if months is None:
        months = sorted(row.month for row in watched.select(F.col("month").cast("int").alias("month")).distinct().collect()
                        if row.month is not None)
    return month_grid(monthly, watchlist, list(months))


def events_sorted(events: DataFrame) -> DataFrame:
    """Event ids by day, latest first. The last sort term only lets Spark cut a run of equal rows between tasks."""
    return events.sparkSession.sql(
        """
        SELECT SQLDATE, Actor1Geo_CountryCode, GLOBALEVENTID
        FROM {events}
        ORDER BY SQLDATE DESC, GLOBALEVENTID, Actor1Geo_CountryCode, monotonically_increasing_id()
        """,
        events=events,
    )


def events_per_day(events: DataFrame) -> DataFrame:
    return events.sparkSession.sql(
        "SELECT SQLDATE, count(*) AS nbEvents FROM {events} GROUP BY SQLDATE", events=events)
