"""Mentions reduced to one row per event."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

_PAYLOAD = (
    "MentionTimeDate", "MentionIdentifier", "SentenceID", "Confidence", "MentionDocTranslationInfo", "SRCLC",
)


def best_mention(mentions: DataFrame, columns: tuple[str, ...] = _PAYLOAD) -> DataFrame:
    """Each event's most confident mention; ties go to the earliest, then by article, sentence and language.

    The least of one struct that begins with the rank and carries nothing twice. An aggregate rather than a ranking
    window: mentions of an event are reduced before the shuffle, so an event with a third of all mentions sends one
    row per map task.
    """
    rank = ("MentionTimeDate", "MentionIdentifier", "SentenceID", "SRCLC")
    rest = [name for name in columns if name not in (*rank, "Confidence")]
    first = F.min(F.struct((-F.col("Confidence").cast("bigint")).alias("doubt"), *rank, *rest)).alias("best")
    confidence = (-F.col("best.doubt")).cast("int").alias("Confidence")
    return mentions.groupBy("GLOBALEVENTID").agg(first).select(
        "GLOBALEVENTID", *(confidence if name == "Confidence" else F.col(f"best.{name}") for name in columns))


def tallied_events(events: DataFrame, mentions: DataFrame, columns: list[str]) -> DataFrame:
    """(GLOBALEVENTID, columns, copies, count, true_mentions): each different event row once, with how often it occurs.

    ``true_mentions`` is the number of mentions of the id, ``count`` the size of events ⟕ mentions for it. One union
    of both inputs, each read once, is reduced by an aggregate with map-side combine before the sums over an id; so
    an id holds as many rows there as it has different event rows, however many copies and mentions.
    """
    facts = events.select("GLOBALEVENTID", *columns, F.lit(1).alias("is_event"), F.lit(0).alias("is_mention")).unionAll(
        mentions.select("GLOBALEVENTID", *(F.lit(None).cast(events.schema[name].dataType) for name in columns),
                        F.lit(0), F.lit(1)))
    counted = facts.groupBy("GLOBALEVENTID", *columns).agg(
        F.sum("is_event").alias("copies"), F.sum("is_mention").alias("mentions"))
    same_id = Window.partitionBy("GLOBALEVENTID")
    return (
        counted.withColumns({
            "true_mentions": F.sum("mentions").over(same_id), "all_copies": F.sum("copies").over(same_id)})
        .where(F.col("copies") > 0)
        .select("GLOBALEVENTID", *columns, "copies",
                (F.col("all_copies") * F.greatest("true_mentions", F.lit(1))).alias("count"), "true_mentions")
    )
