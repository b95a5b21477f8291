"""Zipped text archives on any file system Spark can read.

Archive names are ``<yyyyMMddHHmmss>[.translation].<export.CSV|mentions.CSV|gkg.csv>.zip``. An archive is the unit
of parallelism; Spark packs small ones into tasks by ``spark.sql.files.maxPartitionBytes``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from newsmart.functions import file_name

# Archive name endings by record kind.
SUFFIXES = {"export": "export.CSV.zip", "mentions": "mentions.CSV.zip", "gkg": "gkg.csv.zip"}

_NAME = r"\A([0-9]{8})[0-9]{6}(?:\.translation)?\.(export|mentions|gkg)\.(?:CSV|csv)\.zip\z"


def archive_glob(base: str, period: str, kind: str, digit_follows: bool = False) -> str:
    """Glob of the archives of one kind whose stamp begins with ``period``, translated ones included.

    ``base`` carries the file system (``file:``, ``s3a:``, ``hdfs:`` …). ``digit_follows`` demands one more digit
    after the period, so a period that is a whole stamp matches nothing.
    """
    return f"{base.rstrip('/')}/{period}{'[0-9]' if digit_follows else ''}*.{SUFFIXES[kind]}"


def list_archives(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, name, kind, day, bytes) of archives. The contents are not read: only pruned metadata columns are."""
    name = file_name(F.col("path"))
    return (
        spark.read.format("binaryFile").load(path)
        .select(
            "path",
            name.alias("name"),
            F.regexp_extract(name, _NAME, 2).alias("kind"),
            F.regexp_extract(name, _NAME, 1).alias("day"),
            F.col("length").alias("bytes"),
        )
        .where(F.col("kind") != "")
    )


def read_archive_lines(spark: SparkSession, path: str | list[str], strict: bool = True) -> DataFrame:
    """(path, line) for every line of every entry of the archives at ``path``.

    Unzipping is the one Python step of the library. Lines end at LF, CR or CRLF and leave in bounded Arrow
    batches. A task holds one batch of text and one Arrow batch of compressed archives, which Spark closes at
    ``spark.sql.execution.arrow.maxBytesPerBatch`` (64 MB unless set) or at the archive that passes it. A file that
    is no zip and a damaged archive fail the job, or are passed over when ``strict`` is off (see
    ``unreadable_archives``).
    """
    return _scan(_contents(spark, path), strict).where(F.col("line").isNotNull())


def scan_archives(spark: SparkSession, path: str | list[str], wanted: DataFrame) -> DataFrame:
    """(path, line, problem) of the archives at ``path`` that are in ``wanted`` (path): lines without a problem, and
    one row with a problem and no line for each archive that cannot be read to its end.

    A join would move the contents, so the wanted paths are looked up where the files are read; they are a part of
    the period's file listing, which the driver holds for any scan.
    """
    names = F.broadcast(wanted.select("path").distinct())
    return _scan(_contents(spark, path).join(names, "path", "left_semi"), strict=False)


def unreadable_archives(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, problem) of archives that are no zip or are damaged."""
    return _scan(_contents(spark, path), strict=False).where(F.col("line").isNull()).select("path", "problem")


def _contents(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def _scan(contents: DataFrame, strict: bool) -> DataFrame:
    def unzip(batches):  # nested, so that it travels by value and the executors need no copy of this package
        import io
        import zipfile
        import zlib

        import pyarrow as pa

        chunk = 4 << 20
        schema = pa.schema([("path", pa.string()), ("line", pa.string()), ("problem", pa.string())])

        def batch(name, lines, problem=None):
            count = len(lines)
            return pa.record_batch(
                [pa.array([name] * count, pa.string()), pa.array(lines, pa.string()),
                 pa.array([problem] * count, pa.string())], schema=schema)

        for incoming in batches:
            for name, content in zip(incoming.column("path"), incoming.column("content")):
                name = name.as_py()
                source = pa.BufferReader(content.as_buffer())
                if source.read(2) != b"PK":
                    if strict:
                        raise ValueError(f"{name} is not a zip archive")
                    yield batch(name, [None], "not a zip archive")
                    continue
                try:
                    with zipfile.ZipFile(source) as archive:
                        for entry in archive.infolist():
                            with archive.open(entry) as raw:
                                text = io.TextIOWrapper(raw, encoding="utf-8", errors="replace", newline=None)
                                while lines := text.readlines(chunk):
                                    yield batch(name, [line.removesuffix("\n") for line in lines])
                except (zipfile.BadZipFile, zlib.error, EOFError, NotImplementedError, RuntimeError) as error:
                    if strict:
                        raise ValueError(f"damaged archive {name}: {error}") from error
                    yield batch(name, [None], f"damaged: {error}")

    return contents.mapInArrow(unzip, "path string, line string, problem string")
