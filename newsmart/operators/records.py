"""Tab-separated lines → typed relations.

All native expressions: a plan that needs three of an event's 61 fields evaluates three.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from newsmart.functions import source_language
from newsmart.functions.lenient import double_or_zero_sql, whole_or_zero_sql
from newsmart.schemas import EVENT_FIELDS, FIELD_COUNT, GKG_FIELDS, MENTION_FIELDS

from .once import once

_READERS = {
    "s": lambda text: text,
    "i": lambda text: whole_or_zero_sql(text, "int"),
    "l": lambda text: whole_or_zero_sql(text, "bigint"),
    "n": lambda text: whole_or_zero_sql(text, "decimal(38,0)"),
    "d": double_or_zero_sql,
}


def _record(line: Column) -> Column:
    return F.rtrim(line, F.lit("\t"))  # trailing empty fields do not count


def _fields(line: Column) -> Column:
    return F.split(_record(line), "\t")


def _well_formed(kind: str, count: Column) -> Column:
    fewest, most = FIELD_COUNT[kind]
    return count == fewest if fewest == most else count >= fewest


def with_field_count(lines: DataFrame) -> DataFrame:
    return lines.withColumn("n_fields", F.size(_fields(F.col("line"))))


def rejected_lines(lines: DataFrame, kind: str) -> DataFrame:
    """The lines a parser of this kind leaves out, with their number of fields."""
    return with_field_count(lines).where(~_well_formed(kind, F.col("n_fields")))


def reject_reason(kind: str, n_fields: Column) -> Column:
    """Why a line with so many fields is no record of this kind; null when it is one."""
    fewest, most = FIELD_COUNT[kind]
    few, many = (F.format_string(f"{word} fields: %d for {fewest}", n_fields) for word in ("too few", "too many"))
    return F.when(_well_formed(kind, n_fields), F.lit(None).cast("string")).when(n_fields < fewest, few).otherwise(many)


def _parse(lines: DataFrame, kind: str, fields, extra: dict[str, Column], keep: tuple[str, ...]) -> DataFrame:
    fewest, _ = FIELD_COUNT[kind]
    split = (
        lines.select(*keep, once(_fields(F.col("line"))).alias("f"))
        .where(_well_formed(kind, F.size("f")))
    )
    # get(), not f[i]: the optimizer may evaluate a later filter on a field before the one on the field count.
    texts = (f"get(f, {i})" if i < fewest else f"coalesce(get(f, {i}), '')" for i in range(len(fields)))
    typed = (f"{_READERS[code](text)} AS {name}" for text, (name, code) in zip(texts, fields))
    records = split.selectExpr(*keep, *typed)
    return records.withColumns(extra) if extra else records


def parse_events(lines: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Event records; ``keep`` names columns of ``lines`` to carry along."""
    return _parse(lines, "export", EVENT_FIELDS, {}, keep)


def parse_mentions(lines: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Mention records, with the language of the article they come from (SRCLC)."""
    extra = {
        "Extras": F.lit(""),
        "SRCLC": source_language(F.col("MentionDocTranslationInfo")),
        "ENG": F.lit(""),
    }
    return _parse(lines, "mentions", MENTION_FIELDS, extra, keep)


def parse_gkg(lines: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Article-knowledge records."""
    return _parse(lines, "gkg", GKG_FIELDS, {"TranslationInfo": F.lit(""), "Extras": F.lit("")}, keep)
