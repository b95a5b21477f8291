"""Rows of equal key."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

COPIES_IN_A_BLOCK = 10_000


def repeat_rows(df: DataFrame, copies: str, block: int = COPIES_IN_A_BLOCK) -> DataFrame:
    """Each row as often as its column ``copies`` says, in two steps.

    A row first becomes one row per block of copies, these are dealt out, and only then are blocks expanded; so a row
    with very many copies is expanded by many tasks.
    """
    own = df.columns
    blocks = df.withColumn(
        "copy_block", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"({copies} - 1) DIV {block}"))))
    here = F.least(F.lit(block), F.col(copies) - F.col("copy_block") * block).cast("int")
    return blocks.repartition(*own, "copy_block").withColumn(
        "copy", F.explode(F.array_repeat(F.lit(0), here))).select(*own)


def collapse_to_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key, as a store that overwrites rows of equal key would keep; loses data, so nothing calls it
    by default. The survivor is the greatest row by its remaining columns, in their order; a null is the least.
    """
    rest = [name for name in df.columns if name not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.max(F.struct(*rest)).alias("kept"))
        .select(*(F.col(name) if name in keys else F.col(f"kept.{name}").alias(name) for name in df.columns))
    )
