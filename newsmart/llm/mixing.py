"""Mixing sources to target weights by iterative proportional fitting, in DataFrame functions alone.

Tokens are summed per cell (source, language, topic). Raking multiplies cell weights by target over actual, one margin
after the other, until every margin agrees. No document is taken more than once, so a cell gives at most what it has: the
multiplier of a margin's value is the one with which its open cells make up for its full ones, and a full cell keeps
its weight, by which it opens again when another margin asks for less. A value that holds fewer tokens than its share of
the budget gives all, and the other values share what is left of it. Cells give weight over tokens as the probability of
their documents, which are sampled by a hash of their id, the same ones on every run.

What is iterated is the cell table, which is as large as the number of different (source, language, topic); a hot
source is a few cells. Margins are sums over a value's cells, stored once a round; the driver reads one row a round.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from .scratch import Scratch

MARGINS = ("source", "lang", "topic")
ROUNDS, STEPS = 40, 3  # rounds over all margins; steps on a margin in each
HUGE = 1e250  # weights beyond this are far over any cell's tokens; keeps margins that cannot be met from overflowing
BROADCAST_CELLS = 100_000  # rows of a few short strings: at most some 10 MB

# Topics by form, told by characters: (name, characters, least share of all characters).
FORMS = (("table", "|", 0.02), ("figures", "0123456789", 0.05), ("shouting", "!*#$%&", 0.02))


def token_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long")


def topic_by_form(text: Column) -> Column:
    """The first form whose characters make up enough of the text, else prose; null text is prose."""
    size = F.length(text)
    topic = F.lit("prose")
    for name, characters, share in reversed(FORMS):
        used = size - F.length(F.translate(text, characters, ""))
        topic = F.when(used > share * size, name).otherwise(topic)
    return topic


def described(docs: DataFrame, topic: Column | None = None) -> DataFrame:
    """``docs`` with __source, __lang, __topic (null: "unknown") and __tokens."""
    topic = topic_by_form(F.col("text")) if topic is None else topic
    return docs.withColumns({
        "__source": F.coalesce(F.col("source").cast("string"), F.lit("unknown")),
        "__lang": F.coalesce(F.col("lang").cast("string"), F.lit("unknown")),
        "__topic": F.coalesce(topic, F.lit("unknown")), "__tokens": token_count(F.col("text"))})


def tempered(cells: DataFrame, margin: str, power: float) -> DataFrame:
    """Target shares (value, share): present shares to the power ``power``; 1 leaves them, 0 makes all values equal."""
    shares = cells.groupBy(margin).agg(F.sum("tokens").alias("held")).where("held > 0").select(
        F.col(margin).alias("value"), F.pow("held", F.lit(power)).alias("part"))
    return shares.select("value", (F.col("part") / (shares.agg(F.sum("part")).first()[0] or 1.0)).alias("share"))


def reachable(cells: DataFrame, margin: str, target: DataFrame, budget: float) -> DataFrame:
    """(value, want, wish): of ``budget`` tokens, those each value of ``margin`` is to have (``wish``) and can have (``want``).

    A value that holds fewer tokens than its share gives all it has, and the others share what is left.
    """
    held = cells.groupBy(F.col(margin).alias("value")).agg(F.sum("tokens").alias("held"))
    values = held.join(target, "value").select("value", "held", (F.col("share") * budget).alias("wish"))
    scale, full = 1.0, -1
    while True:
        short = F.col("wish") * scale >= F.col("held")
        row = values.agg(
            F.count(F.when(short, 1)).alias("full"), F.coalesce(F.sum(F.when(short, F.col("held"))), F.lit(0)).alias("whole"),
            F.coalesce(F.sum(F.when(~short, F.col("wish"))), F.lit(0.0)).alias("open")).first()
        if row.full == full or not row.open:
            break
        full, scale = row.full, max(scale, (budget - row.whole) / row.open)
    return values.select("value", F.least(F.col("wish") * scale, F.col("held")).alias("want"), "wish")


def bounded_rake(cells: DataFrame, targets: dict[str, DataFrame], fraction: float, scratch: Scratch,
                 tolerance: float = 1e-9, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """Cells (margins, tokens) with ``weight`` and ``probability``, and (margin, value, wish, want, got) for every value.

    ``wish`` is the value's share of ``fraction`` of all tokens, ``want`` what of it there is, ``got`` what the probabilities
    are expected to give. Cells are raked until ``got`` is ``want`` within ``tolerance`` everywhere; margins that cannot be
    met together end after ``rounds`` and show by ``got``. A value without a target gets nothing.
    """
    budget = fraction * (cells.agg(F.sum("tokens")).first()[0] or 0)
    for margin, target in targets.items():
        cells = cells.join(reachable(cells, margin, target, budget).select(
            F.col("value").alias(margin), F.col("want").alias(f"want_{margin}"), F.col("wish").alias(f"wish_{margin}")),
            margin, "left").fillna(0.0, [f"want_{margin}", f"wish_{margin}"])
    cells = scratch.keep(cells.withColumn("weight", F.col("tokens") * F.lit(float(fraction))), "cells")
    taken = F.least("weight", F.col("tokens").cast("double"))
    is_full = F.col("weight") >= F.col("tokens")
    for _ in range(rounds):
        moved = cells
        for margin in (name for name in targets for _ in range(STEPS)):  # more cells become full, or open, with a step
            part = Window.partitionBy(margin)  # its cells, of the small table
            moved = moved.withColumns({
                "whole": F.sum(F.when(is_full, F.col("tokens")).otherwise(0)).over(part),
                "open": F.sum(F.when(is_full, 0.0).otherwise(F.col("weight"))).over(part), "held": F.sum(taken).over(part)})
            want = F.col(f"want_{margin}")
            factor = F.when((want > F.col("whole")) & (F.col("open") > 0), (want - F.col("whole")) / F.col("open")).when(
                want >= F.col("whole"), F.lit(1.0)).otherwise(F.coalesce(F.try_divide(want, "held"), F.lit(0.0)))
            moved = moved.withColumn("weight", F.least(F.col("weight") * factor, F.lit(HUGE))).drop("whole", "open", "held")
        moved = scratch.keep(moved, "cells")
        gap = _margins(moved, targets, taken).agg(F.max(F.abs(F.try_divide("got", "want") - 1))).first()[0]
        scratch.drop(cells)
        cells = moved
        if gap is None or gap < tolerance:
            break
    return cells.withColumn("probability", F.coalesce(F.try_divide(taken, "tokens"), F.lit(0.0))), _margins(cells, targets, taken)


def _margins(cells: DataFrame, targets: dict[str, DataFrame], taken: Column) -> DataFrame:
    return reduce(DataFrame.unionAll, (
        cells.groupBy(margin).agg(F.max(f"wish_{margin}").alias("wish"), F.max(f"want_{margin}").alias("want"), F.sum(taken).alias("got"))
        .select(F.lit(margin).alias("margin"), F.col(margin).alias("value"), "wish", "want", "got") for margin in targets))


def missed(margins: DataFrame, tolerance: float = 1e-3) -> DataFrame:
    """(margin, value, wish, got) of the values that get noticeably more or less than their share of the budget."""
    return margins.where(F.abs(F.col("got") - F.col("wish")) > tolerance * F.col("wish")).select("margin", "value", "wish", "got")


def draw(doc_id: Column, text: Column, seed: int) -> Column:
    """A number in [0, 1) from a document's id, or from its text where it has none."""
    name = F.concat(F.coalesce(doc_id.cast("string"), text, F.lit("")), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(name), 1, 13), 16, 10).cast("long") / float(16 ** 13)


def token_cells(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(source, lang, topic, tokens) of described ``docs``, without empty cells."""
    return scratch.keep(
        docs.groupBy(*(F.col(f"__{name}").alias(name) for name in MARGINS)).agg(F.sum("__tokens").alias("tokens"))
        .where("tokens > 0"), "cells")


def mixing_plan(docs: DataFrame, fraction: float, powers: dict[str, float] | None, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(source, lang, topic, probability) of described ``docs``, and the margins of ``bounded_rake``."""
    cells = token_cells(docs, scratch)
    targets = {name: tempered(cells, name, power) for name, power in (powers or dict.fromkeys(MARGINS, 0.5)).items()}
    plan, margins = bounded_rake(cells, targets, fraction, scratch)
    return plan.select(*MARGINS, "probability"), margins


def with_probability(docs: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    """Described ``docs`` with __probability and __kept. The plan is broadcast when it is counted to be small."""
    keyed = plan.select(*(F.col(name).alias(f"__{name}") for name in MARGINS),
                        F.col("probability").alias("__probability"))
    if keyed.count() <= BROADCAST_CELLS:
        keyed = F.broadcast(keyed)
    # Documents without tokens are in no cell; they cost nothing and stay.
    return docs.join(keyed, [f"__{name}" for name in MARGINS], "left").withColumn(
        "__probability", F.when(F.col("__tokens") == 0, 1.0).otherwise(F.coalesce("__probability", F.lit(0.0)))
    ).withColumn("__kept", draw(F.col("doc_id"), F.col("text"), seed) < F.col("__probability"))


def mix_with_margins(docs: DataFrame, fraction: float = 0.5, powers: dict[str, float] | None = None, seed: int = 1,
                     scratch: Scratch | None = None) -> tuple[DataFrame, DataFrame]:
    """(doc_id, source, lang, topic, tokens, probability, kept) for every row of ``docs`` (doc_id, text, source, lang), and
    (margin, value, wish, want, got) of the margins the probabilities were made for.

    Targets are the present shares of each margin to its power in ``powers`` (default one half for all).
    Defined cases: a null source or language is "unknown"; a text without words has no tokens, probability 1 and
    stays; texts of any length are counted whole; rows that repeat a doc_id share one draw; rows without one draw by text.
    Other columns are ignored; an empty table gives no rows.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    slim = scratch.keep(
        described(docs.select("doc_id", "text", "source", "lang"))
        .withColumn("text", F.when(F.col("doc_id").isNull(), F.col("text"))), "described")
    plan, margins = mixing_plan(slim, fraction, powers, scratch)
    return with_probability(slim, plan, seed).select(
        "doc_id", *(F.col(f"__{name}").alias(name) for name in MARGINS), F.col("__tokens").alias("tokens"),
        F.col("__probability").alias("probability"), F.col("__kept").alias("kept")), margins


def mix(docs: DataFrame, fraction: float = 0.5, powers: dict[str, float] | None = None, seed: int = 1,
        scratch: Scratch | None = None) -> DataFrame:
    """The rows of ``mix_with_margins``."""
    return mix_with_margins(docs, fraction, powers, seed, scratch)[0]


def sampled_to_margins(docs: DataFrame, fraction: float = 0.5, powers: dict[str, float] | None = None, seed: int = 1,
                       scratch: Scratch | None = None) -> tuple[DataFrame, DataFrame]:
    """The rows of ``docs`` that ``mix`` keeps, with their own columns, and the margins that are ``missed``."""
    scratch = scratch or Scratch(docs.sparkSession)
    rows = described(docs)
    slim = scratch.keep(rows.select(*(f"__{name}" for name in (*MARGINS, "tokens"))), "described")
    plan, margins = mixing_plan(slim, fraction, powers, scratch)
    return with_probability(rows, plan, seed).where("__kept").select(*docs.columns), missed(margins)


def sampled(docs: DataFrame, fraction: float = 0.5, powers: dict[str, float] | None = None, seed: int = 1,
            scratch: Scratch | None = None) -> DataFrame:
    """The rows of ``docs`` that ``mix`` keeps, with their own columns."""
    return sampled_to_margins(docs, fraction, powers, seed, scratch)[0]
