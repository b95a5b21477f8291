"""Groups of rows that arrive next to each other in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F


def gathered(df: DataFrame, *keys: str) -> DataFrame:
    """Rows with equal keys in one partition and next to each other."""
    return df.repartition(*keys).sortWithinPartitions(*keys)


def paired_blocks(rows: DataFrame, keys: list[str], member: str, block: int) -> DataFrame:
    """Rows of (keys, member) repeated once for every pair of blocks their block is in, of the group ``keys``.

    A group of n rows has ceil(n / block) blocks, filled by a hash of ``member``; ``one`` <= ``other`` name the pair
    and ``mine`` the row's own block. Two rows of a group meet in exactly one pair, and no pair holds more than about
    two blocks, however large the group is.
    """
    sizes = rows.groupBy(*keys).count().select(*keys, F.ceil(F.col("count") / block).cast("int").alias("blocks"))
    met = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda at: F.struct(
        F.least("mine", at).alias("one"), F.greatest("mine", at).alias("other")))
    return (
        rows.join(sizes, keys).withColumn("mine", F.pmod(F.xxhash64(member, F.lit("block")), "blocks").cast("int"))
        .withColumn("met", F.explode(met)).select(*rows.columns, "mine", "met.one", "met.other")
    )


def runs(batches, *keys: str) -> Iterator:
    """Arrow tables, one per run of equal ``keys`` (whole numbers); holds one batch and one run at a time."""
    import numpy as np
    import pyarrow as pa

    def ends(table):
        changed = np.zeros(table.num_rows - 1, bool)
        for key in keys:
            values = table.column(key).to_numpy()
            changed |= values[1:] != values[:-1]
        return [*(np.flatnonzero(changed) + 1), table.num_rows]

    waiting: list = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        start = 0
        for end in ends(table):
            part = table.slice(start, end - start)
            if waiting and any(waiting[0].column(key)[0] != part.column(key)[0] for key in keys):
                yield pa.concat_tables(waiting).combine_chunks()
                waiting = []
            waiting.append(part)
            start = end
    if waiting:
        yield pa.concat_tables(waiting).combine_chunks()


def least_linked(names, a, b):
    """For each place of ``names``, the least name reachable over the links between places a and b."""
    import numpy as np

    order = np.argsort(names, kind="stable")
    label = np.empty(len(names), np.int64)
    label[order] = np.arange(len(names))
    while True:
        before, least = label.copy(), np.minimum(label[a], label[b])
        np.minimum.at(label, a, least)
        np.minimum.at(label, b, least)
        label = np.minimum(label, label[order[label]])
        if (label == before).all():
            return names[order[label]]
