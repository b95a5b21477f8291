"""Intermediate tables in the folder all machines share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, nullcontext

from pyspark.sql import DataFrame, SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, as a whole address; a local session without one gets a folder of
    its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="llm-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", folder)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    whole = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString().rstrip("/")
    return "file://" + whole.removeprefix("file:") if whole.startswith("file:/") and "//" not in whole else whole


def fresh_path(spark: SparkSession, what: str) -> str:
    return f"{shared_folder(spark)}/llm-{what}-{uuid.uuid4().hex}"


class Scratch:
    """Tables written once and read from then on, so that a lost executor costs one stage and never the whole
    lineage. ``drop`` deletes those no longer needed; what a lazy result still reads must stay.

    With ``tidy``, shuffle files go as soon as the table they were for is written, instead of whenever the driver next
    collects its garbage."""

    def __init__(self, spark: SparkSession, tidy: bool = False):
        self._spark = spark
        self._tidy = tidy
        self._kept: list[tuple[DataFrame, str]] = []  # holds the frames, so that none is taken for another

    def keep(self, df: DataFrame, what: str = "table") -> DataFrame:
        path = fresh_path(self._spark, what)
        with _cleaned(self._spark) if self._tidy else nullcontext():
            df.write.option("compression", "zstd").parquet(path)
        kept = self._spark.read.schema(df.schema).parquet(path)
        self._kept.append((kept, path))
        return kept

    def drop(self, *frames: DataFrame) -> None:
        for frame in frames:
            for entry in [entry for entry in self._kept if entry[0] is frame]:
                self._kept.remove(entry)
                target = self._spark._jvm.org.apache.hadoop.fs.Path(entry[1])
                target.getFileSystem(self._spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def _cleaned(spark: SparkSession) -> Iterator[None]:
    """Executions in here remove their shuffle files at their end."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
