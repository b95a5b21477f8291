"""Merging rows into a stored mart by key."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from newsmart import commits
from newsmart.operators import collapse_to_key
from newsmart.schemas import MARTS

from .marts import sorted_by_key, to_mart_schema


def merge_mart(df: DataFrame, mart: str, target: str) -> tuple[int, int]:
    """Merge a mart's rows into those stored at ``target``: a row replaces the one of equal key, or is added. Returns how many
    stored files were replaced and how many were written.

    The key is the mart's lookup key and its descending columns, as the stores it is made for have it; of new rows that share
    a key the greatest stays (``collapse_to_key``). Nulls in a key are equal. Only files that hold a key of the new rows are
    read for their other rows and left out from then on; all others stay as they are, under their names. The new files
    are cut by key and sorted like those of ``write_mart``. No file is changed: a commit names the files that make up the
    mart, so a lost run changes nothing and readers see the rows before or after. What it costs grows with the new rows and
    the files they meet; finding these reads the key columns of all, which a scan skips by the files' statistics where the
    new rows lie close together.
    """
    spark, spec, version = df.sparkSession, MARTS[mart], uuid.uuid4().hex
    keys = [*spec.key, *spec.descending]
    before = commits.latest(spark, target)
    stored = commits.state(spark, target, before)
    staging = f"{target}/_staging/{version}"
    try:
        collapse_to_key(to_mart_schema(df, mart), keys).select(*spec.columns).write.parquet(f"{staging}/new")
        new = spark.read.schema(spec.schema).parquet(f"{staging}/new")
        rows, kept, replaced = new, None, 0
        if stored is not None:
            live = _live(stored, target, mart)
            low, high = new.agg(*(getattr(F, of)(keys[0]) for of in ("min", "max"))).first()
            near = live if low is None else live.where(F.col(keys[0]).between(low, high) | F.col(keys[0]).isNull())
            met = near.join(new.select(*(F.col(name).alias(f"new_{name}") for name in keys)), _same(keys), "left_semi")
            met.select("file").distinct().write.parquet(f"{staging}/met")
            met = spark.read.schema("file string").parquet(f"{staging}/met")
            replaced, kept = met.count(), stored.join(met, "file", "left_anti")
            if replaced:
                others = _live(stored.join(met, "file", "left_semi"), target, mart).join(
                    new.select(*(F.col(name).alias(f"new_{name}") for name in keys)), _same(keys), "left_anti")
                rows = rows.unionByName(others.select(*spec.columns))
        sorted_by_key(rows, mart).write.parquet(f"{target}/version={version}")
        made = [f"version={version}/{name}" for name in commits.names(spark, f"{target}/version={version}")
                if name.startswith("part-")]
        listed = spark.createDataFrame([(name,) for name in made], "file string")
        commits.commit_state(spark, target, before, listed if kept is None else kept.unionAll(listed))
        return replaced, len(made)
    finally:
        commits.delete(spark, staging)


def _same(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, (F.col(name).eqNullSafe(F.col(f"new_{name}")) for name in keys))


def _live(files: DataFrame, target: str, mart: str) -> DataFrame:
    """Rows of the listed files, with ``file``. The list is what any scan of them holds on the driver."""
    spark = files.sparkSession
    paths = [f"{target}/{row.file}" for row in files.collect()]
    rows = spark.read.schema(MARTS[mart].schema).parquet(*paths) if paths else spark.createDataFrame([], MARTS[mart].schema)
    name = F.regexp_extract(F.col("_metadata.file_path") if paths else F.lit(""), "version=[^/]+/[^/]+$", 0)
    return rows.select("*", name.alias("file"))
