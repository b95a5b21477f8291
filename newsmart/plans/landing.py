"""Landing: what the manifest promises, what has arrived, and moving arrivals into a Parquet lake."""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F

from newsmart import commits
from newsmart.functions import file_name, in_period
from newsmart.operators import parse_events, parse_gkg, parse_mentions, reject_reason, with_field_count
from newsmart.sources import archive_glob, list_archives, scan_archives

PARSERS = {"export": parse_events, "mentions": parse_mentions, "gkg": parse_gkg}


def reconcile(manifest: DataFrame, arrived: DataFrame) -> DataFrame:
    """Manifest entries (name, url, size) against arrived files (name, bytes).

    ``status`` is ``missing`` (to be fetched), ``corrupt`` (size differs, to be fetched again) or ``ready``.
    """
    return (
        manifest.select("name", "url", F.col("size").try_cast("bigint").alias("expected"))
        .join(arrived.select("name", "bytes"), "name", "left")
        .withColumn(
            "status",
            F.when(F.col("bytes").isNull(), "missing")
            .when(F.col("bytes").eqNullSafe(F.col("expected")), "ready")
            .otherwise("corrupt"),
        )
    )


class Landed(NamedTuple):
    """What a run did: days that have a new version, (name, problem) of the archives that could not be read and were left
    out, and how many lines the others held, how many became records and how many were rejected."""

    days: list[str]
    rejected: list[tuple[str, str]]
    lines: int = 0
    records: int = 0
    rejected_lines: int = 0


def lake_ledger(spark: SparkSession, lake: str, kind: str) -> DataFrame | None:
    """(name, bytes, day, version, lines, records, rejected, problem), one row an archive, as last committed; None where
    nothing was. ``version`` is the one the archive's day is in; ``lines = records + rejected`` unless there is a problem."""
    return commits.state(spark, f"{lake}/{kind}")


def land_period(spark: SparkSession, base: str, lake: str, kind: str, period: str,
                manifest: DataFrame | None = None) -> Landed:
    """Bring the period's new archives of one kind into ``lake``.

    New is an archive that the ledger does not hold, without a problem, at its present size; with a ``manifest`` (as
    ``select_period`` gives it), only archives that ``reconcile`` calls ready are landed. Every day that gets new archives
    gets a new version, made of the rows of its other archives and those of the new ones, in a folder of its own. Folders
    are never changed. The ledger says which version each day is in; committing it, the last step, makes all days of
    a run visible at once. So a run lost midway changes nothing, and a reader sees a day before or after, never between.
    An archive that comes again replaces its rows, also when it has none left.

    An archive that is no zip or is damaged is reported, and tried again by the next run; what an earlier, readable one of
    its name brought stays. Lines that are no records are stored with their archive, number of fields and the reason
    (``read_rejects``), and counted per archive. Records and rejects are counted again as they lie in the lake and must add
    up to the lines that came in, or the run fails before it commits.

    Each archive is unzipped once. Rows go to files by day through a rebalance, in which adaptive execution splits a day
    that is too big for one task. The driver sees a row per calendar day and per unreadable archive, fewer than the list
    of files that any scan of the archives holds.
    """
    root = f"{lake}/{kind}"
    before = commits.latest(spark, root)
    ledger = commits.state(spark, root, before)
    arrived = list_archives(spark, archive_glob(base, period, kind))
    if manifest is not None:
        ready = reconcile(manifest, arrived).where("status = 'ready'").select("name")
        arrived = arrived.join(ready.distinct(), "name", "left_semi")
    pending = arrived.select("path", "name", "bytes", F.col("day").cast("string").alias("day"))
    if ledger is not None:
        pending = pending.join(ledger.where("problem IS NULL").select("name", "bytes"), ["name", "bytes"], "left_anti")
    version = uuid.uuid4().hex
    staging = f"{root}/_staging/{version}"
    try:
        pending = _staged(pending, f"{staging}/pending")
        days = sorted(row.day for row in pending.select("day").distinct().collect())  # one short text per calendar day
        if not days:
            return Landed([], [])
        scanned = scan_archives(spark, [archive_glob(base, day, kind) for day in days], pending)
        told = with_field_count(scanned.withColumn("name", file_name(F.col("path")))).withColumns({
            "day": F.substring("name", 1, 8), "reason": reject_reason(kind, F.col("n_fields"))})
        told = _staged(told.select("name", "day", "line", "problem", "n_fields", "reason"), f"{staging}/lines")
        bad = told.where("problem IS NOT NULL").select("name", "problem").distinct()
        rejected = sorted((row["name"], row.problem) for row in bad.collect())
        good = told.where("line IS NOT NULL").join(bad.select("name"), "name", "left_anti")
        counts = good.groupBy("name").agg(F.count("*").alias("lines"), F.count("reason").alias("rejected"))

        new = pending.join(bad.select("name"), "name", "left_anti").select("name", "bytes", "day")
        held = None if ledger is None else ledger.join(new.select("name"), "name", "left_anti")
        records = PARSERS[kind](good.select(F.col("name").alias("archive"), "day", "line"), keep=("archive", "day"))
        rejects = good.where("reason IS NOT NULL").select(F.col("name").alias("archive"), "day", "n_fields", "reason", "line")
        stored = []
        for rows, rejected_ones in ((records, False), (rejects, True)):
            old = _rows_of(spark, lake, kind, held, days, rejected_ones, rows.columns)
            place = f"{_root(lake, kind, rejected_ones)}/version={version}"
            (rows if old is None else rows.unionByName(old)).hint("rebalance", "day").write.partitionBy("day").parquet(place)
            found = spark.read.schema("archive string").parquet(place).join(new.select(F.col("name").alias("archive")), "archive")
            stored.append(found.count())
        lines = counts.agg(F.coalesce(F.sum("lines"), F.lit(0))).first()[0]
        if lines != sum(stored):
            raise RuntimeError(f"{kind}: {lines} lines came in, {stored[0]} records and {stored[1]} rejects are stored")

        zero = F.lit(0).cast("long")
        entries = new.join(counts, "name", "left").select(
            "name", "bytes", "day", F.lit(version).alias("version"), F.coalesce("lines", zero).alias("lines"),
            (F.coalesce("lines", zero) - F.coalesce("rejected", zero)).alias("records"),
            F.coalesce("rejected", zero).alias("rejected"), F.lit(None).cast("string").alias("problem"))
        damaged = pending.join(bad, "name").select(
            "name", "bytes", "day", F.lit(version).alias("version"), *(zero.alias(name) for name in ("lines", "records", "rejected")),
            "problem")
        if held is not None:
            readable = held.where("problem IS NULL").select("name")
            damaged = damaged.join(readable, "name", "left_anti")
            kept = held.join(damaged.select("name"), "name", "left_anti")
            entries = entries.unionByName(kept.withColumn(
                "version", F.when(F.col("day").isin(days), F.lit(version)).otherwise(F.col("version"))).select(*entries.columns))
        commits.commit_state(spark, root, before, _staged(entries.unionByName(damaged), f"{staging}/entries"))
        written = sorted(row.day for row in new.select("day").distinct().collect())
        return Landed(written, rejected, lines, *stored)
    finally:
        commits.delete(spark, staging)


def _staged(rows: DataFrame, path: str) -> DataFrame:
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _root(lake: str, kind: str, rejects: bool) -> str:
    return f"{lake}/_rejects/{kind}" if rejects else f"{lake}/{kind}"


def _rows_of(spark: SparkSession, lake: str, kind: str, held: DataFrame | None, days: list[str], rejects: bool,
             columns: list[str]) -> DataFrame | None:
    """The lake's rows of ``days`` that are of archives in ``held``; None where there are none."""
    found = [] if held is None else [place for place in _places(spark, lake, kind, rejects) if place[0] in days]
    if not found:
        return None
    return _read_places(spark, lake, kind, found, rejects).withColumn("day", F.col("day").cast("string")).join(
        held.select(F.col("name").alias("archive")), "archive", "left_semi").select(*columns)


def _places(spark: SparkSession, lake: str, kind: str, rejects: bool, period: str = "") -> list[tuple[str, str]]:
    """(day, version) of the period's days that hold rows; one per calendar day."""
    ledger = lake_ledger(spark, lake, kind)
    if ledger is None:
        return []
    found = ledger.where(F.col("day").startswith(period[:8])).groupBy("day", "version").agg(
        F.sum("rejected" if rejects else "records").alias("n")).where("n > 0")
    return sorted((row.day, row.version) for row in found.collect())


def _read_places(spark: SparkSession, lake: str, kind: str, places: list[tuple[str, str]], rejects: bool) -> DataFrame:
    root = _root(lake, kind, rejects)
    return spark.read.option("basePath", root).parquet(
        *(f"{root}/version={version}/day={day}" for day, version in places)).drop("version")


def read_lake(spark: SparkSession, lake: str, kind: str, period: str = "") -> DataFrame:
    """Typed records of a period of any length, a year or a single archive's stamp.

    Only the folders of the period's days, in their committed versions, are listed; within a day, rows are told by their
    archive's stamp, which reaches the scan as a filter. A period without records raises PATH_NOT_FOUND.
    """
    places = _places(spark, lake, kind, False, period)
    if not places:
        raise FileNotFoundError(f"PATH_NOT_FOUND: {lake} holds no {kind} records of the period {period or 'at all'}")
    found = _read_places(spark, lake, kind, places, False)
    return found if len(period) <= 8 else found.where(in_period(F.col("archive"), period))


def read_rejects(spark: SparkSession, lake: str, kind: str, period: str = "") -> DataFrame:
    """(archive, n_fields, reason, line, day) of the period's lines that are no records; no rows where all were."""
    places = _places(spark, lake, kind, True, period)
    if not places:
        return spark.createDataFrame([], "archive string, n_fields int, reason string, line string, day int")
    found = _read_places(spark, lake, kind, places, True)
    return found if len(period) <= 8 else found.where(in_period(F.col("archive"), period))


def vacuum_lake(spark: SparkSession, lake: str, kind: str, keep: int = 2) -> list[str]:
    """Remove versions and states that none of the last ``keep`` commits needs, among them those of lost runs; returns the
    versions removed. Not to be run beside a landing run, whose version is not committed yet."""
    root, last = f"{lake}/{kind}", commits.latest(spark, f"{lake}/{kind}")
    if not last.number:
        return []
    kept = [commits.at(spark, root, number) for number in range(max(1, last.number - keep + 1), last.number + 1)]
    used = {row.version for commit in kept for row in commits.state(spark, root, commit).select("version").distinct().collect()}
    gone = [name for name in commits.names(spark, root)
            if name.startswith("version=") and name.removeprefix("version=") not in used]
    for name in gone:
        commits.delete(spark, f"{root}/{name}")
        commits.delete(spark, f"{lake}/_rejects/{kind}/{name}")
    for name in commits.names(spark, f"{root}/_states"):
        if name not in {commit.state for commit in kept}:
            commits.delete(spark, f"{root}/_states/{name}")
    return [name.removeprefix("version=") for name in gone]
