"""The feed's file list: ``size md5 url``, space-separated, no header."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from newsmart.functions import file_name
from newsmart.schemas import MANIFEST_SCHEMA


def read_manifest(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.csv(path, sep=" ", schema=MANIFEST_SCHEMA)


def select_period(manifest: DataFrame, period: str) -> DataFrame:
    """Entries whose file stamp begins with ``period``, with the file's name."""
    return manifest.where(F.col("url").contains(f"/{period}")).withColumn("name", file_name(F.col("url")))


def union_manifests(original: DataFrame, translated: DataFrame) -> DataFrame:
    return original.unionByName(translated)
