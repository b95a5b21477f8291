"""The monthly roll-up of mart D, kept up to date without reading days again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from newsmart import commits
from newsmart.sinks import to_mart_schema

from .marts import monthly_from_states, pair_state

MART = "queryd2monthly"


def refresh_monthly(mart_d: DataFrame, target: str, period: str) -> list[int]:
    """Bring mart D of ``period`` into the monthly roll-up stored at ``target``; returns the months made anew.

    The period's partial sums are stored, by month, in place of those an earlier run stored for it. Only the months that
    they or their predecessors are in are made again, from the partial sums of all periods; no other day of mart D is read.
    Files are never changed, and one commit makes the new months visible together. A period that overlaps another stored
    one is refused, as its days would count twice. The driver sees one row per period and month; months
    that are no number are one there, -1.
    """
    spark, version = mart_d.sparkSession, uuid.uuid4().hex
    before = commits.latest(spark, target)
    stored = commits.state(spark, target, before)
    known = [] if stored is None else [tuple(row) for row in stored.select("kind", "period", "month", "version").collect()]
    for kind, other, *_ in known:
        if kind == "state" and other != period and (other.startswith(period) or period.startswith(other)):
            raise ValueError(f"{MART}: period {period} overlaps the stored period {other}")
    _write(pair_state(mart_d), f"{target}/states/version={version}")
    new = _months(spark, f"{target}/states/version={version}")
    changed = new | {month for kind, other, month, _ in known if kind == "state" and other == period}
    states = [entry for entry in known if entry[0] == "state" and entry[1] != period]
    states += [("state", period, month, version) for month in new]
    marts = [entry for entry in known if entry[0] == "mart" and entry[2] not in changed]
    wanted = [(month, of) for _, _, month, of in states if month in changed]
    if wanted:
        made = monthly_from_states(_read(spark, f"{target}/states", wanted))
        _write(made, f"{target}/mart/version={version}")
        marts += [("mart", "", month, version) for month in _months(spark, f"{target}/mart/version={version}")]
    if changed:
        rows = spark.createDataFrame(states + marts, "kind string, period string, month int, version string")
        commits.commit_state(spark, target, before, rows)
    return sorted(changed)


def read_monthly(spark: SparkSession, target: str) -> DataFrame:
    """The roll-up as last committed, in the columns of its mart."""
    stored = commits.state(spark, target)
    if stored is None:
        raise FileNotFoundError(f"PATH_NOT_FOUND: no {MART} at {target}")
    places = [(row.month, row.version) for row in stored.where("kind = 'mart'").collect()]
    rows = _read(spark, f"{target}/mart", places) if places else spark.createDataFrame(
        [], "country1 string, country2 string, month string, mean_tone double, n_articles long")
    return to_mart_schema(rows, MART)


def _write(rows: DataFrame, folder: str) -> None:
    part = F.coalesce(F.col("month").try_cast("int"), F.lit(-1))
    rows.withColumn("part", part).hint("rebalance", "part").write.partitionBy("part").parquet(folder)


def _months(spark: SparkSession, folder: str) -> set[int]:
    return {int(name.removeprefix("part=")) for name in commits.names(spark, folder) if name.startswith("part=")}


def _read(spark: SparkSession, root: str, places: list[tuple[int, str]]) -> DataFrame:
    paths = (f"{root}/version={version}/part={month}" for month, version in places)
    return spark.read.option("basePath", root).parquet(*paths).drop("version", "part")
