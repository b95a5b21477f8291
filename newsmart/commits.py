"""Numbered commits of a table whose files are never changed.

A commit is one small file, ``_commits/<number>``, that names a state of the table: a folder ``_states/<name>`` with one row
for each thing the table is made of. Readers take the state of the last commit, so they go from one state to the next at
once, and what was written for a state that was never committed is not seen. A number can be taken once: of two
writers that began from the same state, the second fails and changes nothing.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession


class Commit(NamedTuple):
    """A commit's number, 0 before the first, and the name of its state."""

    number: int
    state: str


def _files(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def delete(spark: SparkSession, path: str) -> None:
    place, files = _files(spark, path)
    files.delete(place, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none where there is no such folder."""
    place, files = _files(spark, path)
    return sorted(status.getPath().getName() for status in files.listStatus(place)) if files.exists(place) else []


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename, which fails where ``target`` exists."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    place, _ = _files(spark, source)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), spark._jsc.hadoopConfiguration())
    plain = gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    context.rename(place, jvm.org.apache.hadoop.fs.Path(target), plain)


def latest(spark: SparkSession, root: str) -> Commit:
    """The last commit of the table at ``root``."""
    numbers = [int(name) for name in names(spark, f"{root}/_commits") if name.isdigit()]
    if not numbers:
        return Commit(0, "")
    return at(spark, root, max(numbers))


def at(spark: SparkSession, root: str, number: int) -> Commit:
    """The commit with this number."""
    place, files = _files(spark, f"{root}/_commits/{number:010d}")
    reader = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(files.open(place), "UTF-8"))
    try:
        return Commit(number, reader.readLine())
    finally:
        reader.close()


def state(spark: SparkSession, root: str, commit: Commit | None = None) -> DataFrame | None:
    """The rows of a commit's state, the last one's unless told; None before the first commit."""
    commit = commit or latest(spark, root)
    return spark.read.parquet(f"{root}/_states/{commit.state}") if commit.number else None


def commit_state(spark: SparkSession, root: str, before: Commit, rows: DataFrame) -> Commit:
    """Store ``rows`` as a new state and make it the one that follows ``before``."""
    made = Commit(before.number + 1, uuid.uuid4().hex)
    rows.coalesce(1).write.parquet(f"{root}/_states/{made.state}")
    waiting = f"{root}/_commits/_{made.state}"
    place, files = _files(spark, waiting)
    out = files.create(place, False)
    out.write(bytearray(f"{made.state}\n".encode()))
    out.close()
    try:
        move(spark, waiting, f"{root}/_commits/{made.number:010d}")
    except Exception as error:
        files.delete(place, False)
        if "FileAlreadyExists" in str(error):
            raise RuntimeError(f"{root}: another run has committed number {made.number}; nothing was changed") from error
        raise
    return made
