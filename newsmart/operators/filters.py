"""Filters on country pairs."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame, functions as F

# Pairs of names for the same country, which say nothing about relations between two.
ALIAS_PAIRS: tuple[tuple[str, str], ...] = (
    ("American", "Americans"),
    ("America", "United States"),
    ("American", "United States"),
    ("Americans", "United States"),
    ("America", "Americans"),
    ("America", "American"),
    ("China", "Chinese"),
)

# The countries watched.
WATCHLIST: tuple[str, ...] = ("Mexico", "United States", "China", "France", "Russia", "Iran")


def exclude_pairs(pairs: DataFrame, excluded: tuple[tuple[str, str], ...] = ALIAS_PAIRS) -> DataFrame:
    """Rows whose (country1, country2) is none of the listed pairs; a pushed-down filter, no join."""
    if not excluded:
        return pairs
    listed = reduce(lambda a, b: a | b, (
        (F.col("country1") == one) & (F.col("country2") == other) for one, other in excluded))
    return pairs.where(~listed)


def pair_members(watchlist: tuple[str, ...]) -> tuple[list[str], list[str]]:
    """Countries that can come first, and second, in a sorted pair of the watch list."""
    pairs = list(combinations(sorted(watchlist), 2))
    return sorted({one for one, _ in pairs}), sorted({other for _, other in pairs})


def keep_watchlist(pairs: DataFrame, watchlist: tuple[str, ...] = WATCHLIST) -> DataFrame:
    firsts, seconds = pair_members(watchlist)
    return pairs.where(F.col("country1").isin(firsts) & F.col("country2").isin(seconds))
