"""Quality scores from a sparse rule ensemble.

Statistics of whole texts are column expressions, computed in one scan. Rules over them are learned on a bounded sample
of labelled rows and compiled back into a column expression, so scoring is native and moves no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .rules import Condition, extract, holds, lasso
from .scratch import Scratch

SAMPLE_ROWS = 20_000  # labelled rows the rules are learned from, about
PENALTY = 0.002
THRESHOLD = 0.7


def _count(text: Column, pattern: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(pattern)), F.lit(0)).cast("double")


def statistics(text: Column) -> dict[str, Column]:
    """Counts over the whole text; a null text counts as empty. Shares are taken from them by ``shares``."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n")
    return {
        "chars": F.coalesce(F.length(text), F.lit(0)).cast("double"),
        "words": _count(text, r"\S+"),
        "letters": _count(text, r"\p{L}"),
        "capitals": _count(text, r"\p{Lu}"),
        "digits": _count(text, r"\p{N}"),
        "marks": _count(text, r"[.,;:?'\"()-]"),
        "signs": _count(text, r"[^\p{L}\p{N}\s.,;:?'\"()-]"),
        "bars": _count(text, r"\|"),
        "shouts": _count(text, "!"),
        "ends": _count(text, r"[.!?](?:\s|$)"),
        "lines": F.size(lines).cast("double"),
        "other_lines": F.size(F.array_distinct(lines)).cast("double"),
        "other_words": F.size(F.array_distinct(F.split(F.coalesce(text, F.lit("")), r"\s+"))).cast("double"),
    }


def shares() -> dict[str, Column]:
    """The features: sizes, and shares that do not depend on the size of the text."""
    def of(part: str, whole: str) -> Column:
        return F.col(part) / F.greatest(F.col(whole), F.lit(1.0))

    return {
        "log_words": F.log1p("words"), "word_length": of("letters", "words"), "capital_share": of("capitals", "letters"),
        "digit_share": of("digits", "chars"), "mark_share": of("marks", "words"), "sign_share": of("signs", "words"),
        "bar_share": of("bars", "words"), "shout_share": of("shouts", "words"), "sentence_words": of("words", "ends"),
        "line_words": of("words", "lines"), "line_variety": of("other_lines", "lines"),
        "word_variety": F.col("other_words") / F.greatest(F.sqrt("words"), F.lit(1.0)),
    }


def featurized(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, features…) per row."""
    counted = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.expr("coalesce(pmod(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)), 4) = 2, false)").alias("held_out"),
        *(column.alias(name) for name, column in statistics(F.col("text")).items()))
    return counted.select("doc_id", "held_out", *(column.alias(name) for name, column in shares().items()))


def learn(features: DataFrame, labels: DataFrame, label: str = "quality", rows: int = SAMPLE_ROWS,
          penalty: float = PENALTY) -> tuple[float, list[tuple[tuple[Condition, ...], float]]]:
    """Bias and weighted rules from the labelled rows that are not held out; about ``rows`` of them, by a hash.

    With labels of one kind only, the bias alone says so; with none, it says nothing (0).
    """
    import numpy as np

    names = list(shares())
    known = features.where(~F.col("held_out") & F.col("doc_id").isNotNull()).join(
        labels.where(F.col(label).isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"),
                                                      F.col(label).cast("double").alias("__label")), "doc_id")
    share = min(1.0, rows / max(1, known.count()))
    drawn = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    sample = known.where(drawn < share).select("doc_id", *names, "__label").toPandas().sort_values("doc_id")
    values, marks = sample[names].to_numpy(float), (sample["__label"].to_numpy() > 0).astype(float)
    if not len(marks) or marks.min() == marks.max():
        return (0.0 if not len(marks) else 4.0 * (2 * marks[0] - 1)), []
    rules = extract(values, marks)
    bias, weights = lasso(np.stack([holds(values, rule) for rule in rules], axis=1), marks, penalty)
    return bias, [(rule, float(weight)) for rule, weight in zip(rules, weights) if weight]


def compiled(bias: float, rules: list[tuple[tuple[Condition, ...], float]]) -> Column:
    """The score as one column over the features: logistic function of the weights of the rules that hold."""
    names = list(shares())

    def condition(rule: tuple[Condition, ...]) -> Column:
        return reduce(lambda a, b: a & b, (
            F.col(names[column]) > threshold if greater else F.col(names[column]) <= threshold
            for column, greater, threshold in rule))

    margin = sum((F.when(condition(rule), weight).otherwise(0.0) for rule, weight in rules), F.lit(bias))
    return 1 / (1 + F.exp(-margin))


def quality_scores(docs: DataFrame, labels: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of ``docs`` (doc_id, text).

    Defined cases: a null text counts as empty, and an empty text has a score like any other; held_out is false
    without doc_id, and such rows teach nothing. Repeated rows are each scored, and each teaches. A score of exactly
    the threshold is predicted 1. Other columns are ignored; an empty table gives no rows; without labels every
    score is 0.5.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    features = scratch.keep(featurized(docs), "features")
    score = compiled(*learn(features, labels))
    return features.select("doc_id", "held_out", score.alias("score")).withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int"))
