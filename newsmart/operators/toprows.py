"""Rows by rank without gathering the whole frame in one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def without_top_row(df: DataFrame, order: list[Column], key: list[str]) -> DataFrame:
    """All rows but the first in ``order``; ``key`` identifies a row and may hold nulls.

    A bare OFFSET would bring every row to one task. The top row is found by a distributed top-1 instead, and the
    one-row result is all that is broadcast.
    """
    top = df.orderBy(*order).limit(1).select(*(F.col(name).alias(f"top_{name}") for name in key))
    same = reduce(lambda a, b: a & b, (F.col(name).eqNullSafe(F.col(f"top_{name}")) for name in key))
    return df.join(F.broadcast(top), same, "left_anti")
