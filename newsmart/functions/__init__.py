"""Column expressions: each takes Columns and returns a Column, all JVM-side."""

from .dates import date_parts, feed_day, in_period, item_date_parts, reference_period
from .lenient import bigint_or_zero, double_or_zero, int_or_zero, long_or_zero, try_float
from .locations import country_pairs, mentioned_countries
from .text import exact_mean, file_name, first_tone, items, source_language

__all__ = [
    "bigint_or_zero", "country_pairs", "date_parts", "double_or_zero", "exact_mean", "feed_day", "file_name", "first_tone",
    "in_period",    "int_or_zero", "item_date_parts", "items", "long_or_zero", "mentioned_countries", "reference_period",
    "source_language", "try_float",
]
