"""Number parsing that never fails: whatever is not a number becomes 0 (or null, for tones).

``text`` is a column name or any SQL expression of type string. Rules are kept as SQL text because a record has up
to 61 fields to apply them to, in one ``selectExpr``.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_WHOLE = r"\A[+-]?[0-9]+\z"
# Spark reads "inf", "infinity" and "nan" in any case as numbers; the JVM's own parser, whose reading the feed's
# numbers follow, knows only the two exact spellings.
_ANY_CASE_SPECIAL = r"(?i)\A[\x00-\x20]*[+-]?(?:inf|infinity|nan)[\x00-\x20]*\z"
_EXACT_SPECIAL = r"\A[\x00-\x20]*[+-]?(?:Infinity|NaN)[\x00-\x20]*\z"


def whole_or_zero_sql(text: str, type_name: str) -> str:
    # The pattern is needed: a bare cast would also take " 5", and round "1.5" when the target is a decimal.
    return f"coalesce(if({text} RLIKE r'{_WHOLE}', try_cast({text} AS {type_name}), NULL), CAST(0 AS {type_name}))"


def try_float_sql(text: str, type_name: str) -> str:
    # Blank text is common and a failing cast is slow, so it is caught before; only a text with an n can be special.
    misspelt = f"{text} RLIKE r'{_ANY_CASE_SPECIAL}' AND NOT {text} RLIKE r'{_EXACT_SPECIAL}'"
    return f"CASE WHEN {text} = '' THEN NULL WHEN (contains({text}, 'n') OR contains({text}, 'N')) AND {misspelt} " \
           f"THEN NULL ELSE try_cast({text} AS {type_name}) END"


def double_or_zero_sql(text: str) -> str:
    return f"coalesce({try_float_sql(text, 'double')}, 0D)"


def int_or_zero(text: str) -> Column:
    return F.expr(whole_or_zero_sql(text, "int"))


def long_or_zero(text: str) -> Column:
    return F.expr(whole_or_zero_sql(text, "bigint"))


def bigint_or_zero(text: str) -> Column:
    return F.expr(whole_or_zero_sql(text, "decimal(38,0)"))


def double_or_zero(text: str) -> Column:
    return F.expr(double_or_zero_sql(text))


def try_float(text: str, type_name: str) -> Column:
    """Text as ``float`` or ``double``; null when it is not a number."""
    return F.expr(try_float_sql(text, type_name))
