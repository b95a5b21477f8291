"""Marts as written by ``newsmart.sinks``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from newsmart import commits
from newsmart.schemas import MARTS


def read_mart(spark: SparkSession, path: str, mart: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """A mart from Parquet or headerless CSV, or through a table connector named by ``fmt``. Of a merged mart, the files that
    its last commit names."""
    if fmt == "parquet" and (merged := commits.state(spark, path)) is not None:
        files = [f"{path}/{row.file}" for row in merged.collect()]  # a scan holds the list of its files anyway
        return spark.read.options(**options).schema(MARTS[mart].schema).parquet(*files) if files else spark.createDataFrame(
            [], MARTS[mart].schema)
    reader = spark.read.format(fmt).options(**options)
    if fmt in ("parquet", "csv"):
        # A mart stored by period has the period as a partition column, which is not the mart's.
        return reader.schema(MARTS[mart].schema).load(path).select(*MARTS[mart].columns)
    return reader.load().select(*MARTS[mart].columns)
