"""Reading the delimited sub-records inside text fields."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .lenient import try_float


def source_language(translation_info: Column) -> Column:
    """Language code of ``srclc:fra;eng:…``: first ``;`` part, after its first ``:``; "" when there is none."""
    first = F.substring_index(translation_info, ";", 1)
    return F.substr(first, F.instr(first, ":") + 1)


def first_tone(tone: str, type_name: str) -> Column:
    """The leading value of a tone list ``t,p,n,…``; null when it is not a number."""
    return try_float(f"substring_index({tone}, ',', 1)", type_name)


def exact_mean(name: str) -> Column:
    """Mean of a column of doubles, the same whatever the order of its rows: a sum of decimals with twelve places and
    one division. Values that are no decimals (NaN, infinite, beyond 10^20) make it what adding them up makes it."""
    value = F.col(name).cast("double")
    plain = F.abs(value) < 1e20
    whole = F.sum(F.when(plain, value).try_cast("decimal(38,12)")).cast("double")
    odd = F.sum(F.when(value.isNotNull() & ~plain, value))
    return F.try_divide(F.coalesce(odd, whole), F.count(value))


def items(listing: Column) -> Column:
    """``a;b;`` → [a, b, ""]: the closing ``;`` yields a blank item, and so does an empty list."""
    return F.split(listing, ";")


def file_name(url: Column) -> Column:
    return F.substring_index(url, "/", -1)
