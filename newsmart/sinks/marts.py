"""Writing marts."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, functions as F

from newsmart.schemas import MARTS

# Columns where text that is no number is legal: month and day of an undated article.
LENIENT = ("month", "day")


def _typed(field) -> Column:
    value = F.col(field.name)
    cast = value.try_cast(field.dataType)
    if field.name in LENIENT:
        return cast
    message = F.concat(F.lit(f"{field.name} does not fit {field.dataType.simpleString()}: "), value.cast("string"))
    return F.when(value.isNotNull() & cast.isNull(), F.raise_error(message)).otherwise(cast)


def to_mart_schema(df: DataFrame, mart: str) -> DataFrame:
    """The mart's columns, in its order and types ("01" becomes 1).

    A count or key that does not fit its type fails the job. Month and day become null where they are no numbers.
    """
    return df.select(*(_typed(field).alias(field.name) for field in MARTS[mart].schema))


def write_mart(df: DataFrame, mart: str, target: str, fmt: str = "parquet", mode: str = "overwrite",
               **options: str) -> None:
    """Write a mart as Parquet, as headerless CSV, or through the connector ``fmt``, where ``target`` is unused
    when empty.

    Parquet is range-partitioned and sorted by key and then by the mart's descending columns: the rows of a key
    lie together in order, a lookup opens the one or two files whose statistics cover it, and a key with a third
    of the rows is cut over as many files as it needs.
    """
    out = to_mart_schema(df, mart)
    write_frame(sorted_by_key(out, mart) if fmt == "parquet" else out, target, fmt, mode, **options)


def sorted_by_key(rows: DataFrame, mart: str) -> DataFrame:
    """A mart's rows cut into ranges and sorted by key, then by its descending columns, then by the rest."""
    spec = MARTS[mart]
    ordered = set(spec.key + spec.descending)
    order = [
        *(F.asc(name) for name in spec.key),
        *(F.desc(name) for name in spec.descending),
        *(F.asc(name) for name in spec.columns if name not in ordered),
    ]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order)


def write_period(df: DataFrame, mart: str, target: str, period: str, fmt: str = "parquet", allow_empty: bool = False,
                 **options: str) -> None:
    """Store the mart of one period in its own folder of ``target``, in place of what an earlier run stored there.

    Running a period twice leaves its rows once; other periods are not touched. Rows are written beside the target
    and moved in when they are complete, after the old ones were moved aside; a run lost between the two moves leaves the old
    rows there, and the next run of the period puts them back first. A period that overlaps another stored one
    is refused, as its rows would count twice; so is an empty one, unless ``allow_empty`` says it is meant.
    """
    spark = df.sparkSession
    paths = spark._jvm.org.apache.hadoop.fs.Path
    root = paths(target)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    stored = [status.getPath().getName().removeprefix("period=") for status in
              (files.globStatus(paths(f"{target}/period=*")) or [])]
    for other in stored:
        if other != period and (other.startswith(period) or period.startswith(other)):
            raise ValueError(f"{mart}: period {period} overlaps the stored period {other}")
    staging = f"{target}/_staging-{uuid.uuid4().hex}"
    try:
        write_mart(df, mart, staging, fmt, "errorifexists", **options)
        written = spark.read.format(fmt).schema(MARTS[mart].schema).load(staging)
        if not allow_empty and written.isEmpty():
            raise ValueError(f"{mart}: no rows for period {period}")
        place, aside = paths(f"{target}/period={period}"), paths(f"{target}/_before-{period}")
        if files.exists(aside):  # of a run lost between the two moves below, or after them
            if files.exists(place):
                files.delete(aside, True)
            elif not files.rename(aside, place):
                raise OSError(f"{mart}: cannot move {aside} back to {place}")
        if files.exists(place) and not files.rename(place, aside):
            raise OSError(f"{mart}: cannot move {place} aside")
        if not files.rename(paths(staging), place):
            if files.exists(aside):
                files.rename(aside, place)
            raise OSError(f"{mart}: cannot move {staging} to {place}")
        files.delete(aside, True)
    finally:
        files.delete(paths(staging), True)


def write_frame(df: DataFrame, target: str, fmt: str = "parquet", mode: str = "overwrite", **options: str) -> None:
    writer = df.write.format(fmt).mode(mode).options(**options)
    if target:
        writer.save(target)
    else:
        writer.save()
