"""Sharding by a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a table of prime size. Shards take turns, each claiming
its most preferred free slot, until the table is full; so shards own equally many slots (by weight), and when a shard
is added or removed few slots change hands. The table has ``SLOTS`` rows whatever the data, which is what bounds its
broadcast; a row finds its shard by one hash and one lookup.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SLOTS = 65_537  # prime
SHARDS = 64


def fill_table(shards: list[str], slots: int = SLOTS, turns: list[int] | None = None) -> list[int]:
    """For each slot, the place of its shard in ``shards``; ``turns`` gives how many slots a shard claims per round."""
    def number(shard: str, what: str) -> int:
        return int.from_bytes(hashlib.md5(f"{what}:{shard}".encode()).digest()[:8], "big")

    if not shards or len(shards) > slots:
        raise ValueError("a table needs at least one shard and a slot for each")
    next_slot = [number(shard, "offset") % slots for shard in shards]
    step = [number(shard, "skip") % (slots - 1) + 1 for shard in shards]
    table, free = [-1] * slots, slots
    while True:
        for shard, times in enumerate(turns or [1] * len(shards)):
            for _ in range(times):
                slot = next_slot[shard]
                while table[slot] >= 0:
                    slot = (slot + step[shard]) % slots
                table[slot] = shard
                next_slot[shard] = (slot + step[shard]) % slots
                free -= 1
                if not free:
                    return table


def table_frame(spark: SparkSession, shards: list[str], slots: int = SLOTS, turns: list[int] | None = None) -> DataFrame:
    """(slot, shard), one row per slot."""
    filled = fill_table(shards, slots, turns)
    return spark.createDataFrame([(slot, shard) for slot, shard in enumerate(filled)], "slot int, shard int")


def place(rows: DataFrame, key: Column, shards: list[str], slots: int = SLOTS,
          turns: list[int] | None = None) -> DataFrame:
    """``rows`` with ``slot`` and ``shard``; columns of these names are replaced."""
    own = [name for name in rows.columns if name not in ("slot", "shard")]
    table = F.broadcast(table_frame(rows.sparkSession, shards, slots, turns))
    return rows.select(*own, F.pmod(F.xxhash64(key), F.lit(slots)).cast("int").alias("slot")).join(table, "slot").select(
        *own, "slot", "shard")


def place_documents(docs: DataFrame, shards: list[str] | None = None) -> DataFrame:
    """``docs`` with the shard of each row by its doc_id, all other columns passed on.

    Defined cases: a row without doc_id goes by its text, so that such rows do not share one shard; rows that repeat
    a doc_id share a shard; a null or empty text makes no difference otherwise. An empty table gives no rows.
    """
    key = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text "), F.coalesce("text", F.lit(""))))
    return place(docs, key, shards or [f"shard-{at:05d}" for at in range(SHARDS)])


def write_shards(placed: DataFrame, path: str) -> None:
    """One folder per shard. The rebalance lets adaptive execution cut a shard that is too big for one task."""
    placed.hint("rebalance", "shard").write.partitionBy("shard").parquet(path)
