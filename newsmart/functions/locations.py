"""Countries, and pairs of them, from an article's location list ``type#name#code#…;…``."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_BLANKS = "".join(chr(code) for code in range(0x21))  # what the JVM's String.trim strips
_LOCATION = r"\A.*#.*#.*\z"
_DIGITS = r"\A[\p{Nd}&&[\x{0}-\x{FFFF}]]*\z"


def _trim(text: Column) -> Column:
    return F.btrim(text, F.lit(_BLANKS))


def _country(piece: Column) -> Column:
    """The name in one location piece: its first part or, when that is only a type number, its second."""
    head = _trim(F.substring_index(piece, "#", 1))
    second = _trim(F.get(F.split(F.rtrim(piece, F.lit("#")), "#"), F.lit(1)))
    return F.when(head.rlike(_DIGITS), second).otherwise(head)


def mentioned_countries(locations: Column) -> Column:
    """Distinct country names in order of first mention.

    Names contain commas ("Toronto, Ontario, Canada"), so the list is cut at both ``,`` and ``;`` and a piece
    counts only when it holds two ``#``. A piece that ends before its name is skipped.
    """
    pieces = F.filter(F.split(locations, "[,;]"), lambda piece: piece.rlike(_LOCATION))
    names = F.transform(pieces, _country)
    return F.array_distinct(F.filter(names, lambda name: name.isNotNull()))


def country_pairs(countries: Column) -> Column:
    """All 2-combinations of a list of distinct names, each pair sorted, as array<struct<country1, country2>>.

    Holds the whole quadratic list of one row at once; the mart uses ``operators.explode_pairs``, which does not.
    """
    def with_later(name: Column, index: Column) -> Column:
        later = F.slice(countries, index + 2, F.size(countries))
        return F.transform(later, lambda other: F.struct(
            F.least(name, other).alias("country1"), F.greatest(name, other).alias("country2")))

    return F.flatten(F.transform(countries, with_later))
