"""Near-duplicate documents by MinHash.

1. One Python pass turns each whole text into its shingle set, many universal-hash minima and band keys.
2. Documents with equal sets form a class; only its least document goes on.
3. Each member of a band bucket is paired with the bucket's least document, so candidates grow with the documents and
   never with the square of a bucket. Candidates pass a signature test, then are confirmed on full sets.
4. Connected components by large-star and small-star steps.
5. A pair inside one bucket needs no look when both are in one component already. What is left, pairs in a bucket
   whose documents are in different components, is compared on full sets inside blocks of bounded size, which
   return one spanning link per document and never a list of pairs. Then components are taken again.

Sets are not stored for all documents: they are made again for the documents of candidate pairs.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from .components import connected_components
from .groups import gathered, least_linked, paired_blocks, runs
from .scratch import Scratch
from .shingles import mixed, shingle_set

BANDS, ROWS = 25, 5  # a pair at similarity 0.8 shares a band with probability 0.99995
BLOCK = 1024
BROADCAST_IDS = 500_000  # at most 4 MB of document ids


def sketch(docs: DataFrame, words: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, n_shingles, d1, d2, bands, signature); d1 and d2 identify the set and are null when it is empty."""
    def sketches(batches):
        import numpy as np
        import pyarrow as pa
        import xxhash

        draws = np.random.default_rng(20240229).integers(0, 1 << 63, size=(2, bands * rows), dtype=np.uint64)
        factor, shift = (draws[0] << np.uint64(1) | np.uint64(1))[:, None], draws[1][:, None]
        weights = mixed(np.arange(1, rows + 1, dtype=np.uint64)) | np.uint64(1)
        salt = mixed(np.arange(1, bands + 1, dtype=np.uint64))
        chunk = 1024

        def minima(values):
            least = np.full(bands * rows, np.iinfo(np.uint64).max, np.uint64)
            for at in range(0, len(values), chunk):
                hashed = values[None, at:at + chunk] * factor
                hashed += shift
                np.minimum(least, hashed.min(axis=1), out=least)
            return least >> np.uint64(24)

        for batch in batches:
            n, first, second, keys, signatures = [], [], [], [], []
            for text in batch.column("text"):
                values = shingle_set(text.as_py(), words)
                n.append(len(values))
                if not len(values):
                    for column in (first, second, keys, signatures):
                        column.append(None)
                    continue
                name = xxhash.xxh3_128_digest(values.tobytes())
                first.append(int.from_bytes(name[:8], "little", signed=True))
                second.append(int.from_bytes(name[8:], "little", signed=True))
                least = minima(values)
                keys.append(mixed((least.reshape(bands, rows) * weights).sum(axis=1, dtype=np.uint64) + salt)
                            .view(np.int64))
                signatures.append(least.astype(np.uint16).tobytes())
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(first, pa.int64()),
                 pa.array(second, pa.int64()), pa.array(keys, pa.list_(pa.int64())),
                 pa.array(signatures, pa.binary())],
                names=["doc_id", "n_shingles", "d1", "d2", "bands", "signature"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        sketches, "doc_id long, n_shingles long, d1 long, d2 long, bands array<long>, signature binary")


def _with_both(pairs: DataFrame, values: DataFrame, name: str) -> DataFrame:
    """Pairs (a, b) with ``name`` of both documents; a hot document is a skewed join that adaptive execution splits."""
    for side in ("a", "b"):
        pairs = pairs.join(values.select(F.col("doc_id").alias(side), F.col(name).alias(f"{name}_{side}")), side)
    return pairs


def _agreements(similarity: float, hashes: int = BANDS * ROWS) -> int:
    """How many minima a pair at ``similarity`` shares, less four and a half deviations."""
    return math.floor(hashes * similarity - 4.5 * math.sqrt(hashes * similarity * (1 - similarity)))


def likely(pairs: DataFrame, signatures: DataFrame, similarity: float, hashes: int = BANDS * ROWS) -> DataFrame:
    """Pairs whose signatures agree often enough."""
    least = _agreements(similarity)

    def agreeing(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            one, other = (
                np.frombuffer(b"".join(x.as_buffer() for x in batch.column(name)), np.uint16).reshape(-1, hashes)
                for name in ("signature_a", "signature_b"))
            keep = pa.array((one == other).sum(axis=1) >= least, pa.bool_())
            yield batch.select(["a", "b"]).filter(keep)

    return _with_both(pairs, signatures, "signature").mapInArrow(agreeing, "a long, b long")


def shingles_of(docs: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """(doc_id, shingles) of the documents in ``ids`` (doc_id), which are broadcast when they are counted to be few."""
    def sets(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.record_batch(
                [batch.column("doc_id"),
                 pa.array([shingle_set(text.as_py(), words).tobytes() for text in batch.column("text")], pa.binary())],
                names=["doc_id", "shingles"])

    wanted = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(
        wanted, "doc_id", "left_semi").mapInArrow(sets, "doc_id long, shingles binary")


def confirmed(pairs: DataFrame, docs: DataFrame, words: int, percent: int, scratch: Scratch) -> DataFrame:
    """Pairs with 100 * |intersection| >= percent * |union| of their full shingle sets."""
    def similar(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            keep = []
            for one, other in zip(batch.column("shingles_a"), batch.column("shingles_b")):
                one, other = np.frombuffer(one.as_buffer(), np.uint64), np.frombuffer(other.as_buffer(), np.uint64)
                shared = len(np.intersect1d(one, other, assume_unique=True))
                keep.append(100 * shared >= percent * (len(one) + len(other) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    ids = scratch.keep(pairs.select(F.col("a").alias("doc_id")).unionAll(pairs.select("b")).distinct(), "ids")
    shingles = scratch.keep(shingles_of(docs, ids, words), "sets")
    links = scratch.keep(_with_both(pairs, shingles, "shingles").mapInArrow(similar, "a long, b long").distinct(),
                         "links")
    scratch.drop(shingles, ids)
    return links


def _confirmed_in_blocks(members: DataFrame, sketches: DataFrame, docs: DataFrame, words: int, percent: int,
                         scratch: Scratch, hashes: int = BANDS * ROWS) -> DataFrame:
    """Spanning links (a, b) among members (key, doc_id, component) of a bucket that are in different components."""
    least = _agreements(percent / 100)

    def compare(batches):
        import numpy as np
        import pyarrow as pa

        for run in runs(batches, "key", "one", "other"):
            key, first, second = (run.column(name)[0].as_py() for name in ("key", "one", "other"))
            ids, component, mine = (run.column(name).to_numpy() for name in ("doc_id", "component", "mine"))
            size = len(ids)
            bands = run.column("bands").combine_chunks().flatten().to_numpy().reshape(size, -1)
            signatures = np.frombuffer(
                b"".join(x.as_buffer() for x in run.column("signature")), np.uint16).reshape(size, hashes)
            sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in run.column("shingles")]
            lengths = np.array([len(x) for x in sets])
            starts = np.concatenate([[0], np.cumsum(lengths)])
            known, codes = np.unique(np.concatenate(sets), return_inverse=True)
            # A pair counts in the first band in which it meets.
            band = int(np.flatnonzero(bands[0] == key)[0])
            flags = np.zeros(len(known), bool)
            left = np.flatnonzero(mine == first)
            right = left if first == second else np.flatnonzero(mine == second)
            a, b = [], []
            for x in left:
                y = right[right > x] if first == second else right
                y = y[component[y] != component[x]]
                y = y[(signatures[y] == signatures[x]).sum(axis=1) >= least]
                y = y[~(bands[y, :band] == bands[x, :band]).any(axis=1)]
                if not len(y):
                    continue
                flags[codes[starts[x]:starts[x + 1]]] = True
                places = np.concatenate([codes[starts[at]:starts[at + 1]] for at in y])
                shared = np.add.reduceat(flags[places].astype(np.int64), np.cumsum(lengths[y]) - lengths[y])
                flags[codes[starts[x]:starts[x + 1]]] = False
                y = y[100 * shared >= percent * (lengths[x] + lengths[y] - shared)]
                a.append(np.full(len(y), x))
                b.append(y)
            if sum(map(len, a)):
                root = least_linked(ids, np.concatenate(a), np.concatenate(b))
                new = root != ids
                yield pa.record_batch([pa.array(ids[new]), pa.array(root[new])], names=["a", "b"])

    described = sketches.join(
        scratch.keep(shingles_of(docs, scratch.keep(members.select("doc_id").distinct(), "ids"), words), "sets"), "doc_id")
    rows = paired_blocks(members, ["key"], "doc_id", BLOCK).join(described, "doc_id").where(
        F.array_contains("bands", F.col("key")))  # of a repeated doc_id, the sketches that are in this bucket
    return gathered(rows, "key", "one", "other").mapInArrow(compare, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, scratch: Scratch | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs`` (doc_id, text; other columns are ignored).

    Defined cases: a text that is null, empty or without words has no shingles and links with nothing. A null doc_id
    links with nothing, has a null component and is kept. Rows that repeat a doc_id are one node, whose links are
    those of all its rows; each row is returned. Ties cannot occur: the least doc_id of a component is kept. An
    empty table gives no rows.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    sketches = scratch.keep(sketch(docs, words), "sketches")
    known = sketches.where("d1 IS NOT NULL AND doc_id IS NOT NULL")
    classes = known.groupBy("d1", "d2").agg(F.min("doc_id").alias("least"))
    same = known.select("doc_id", "d1", "d2").join(classes, ["d1", "d2"]).where("doc_id <> least").select(
        F.col("doc_id").alias("a"), F.col("least").alias("b")).distinct()
    # Of rows that repeat a doc_id with other texts, each has its own sketch.
    least = scratch.keep(
        known.join(classes, ["d1", "d2"]).where("doc_id = least").select("doc_id", "bands", "signature")
        .dropDuplicates(["doc_id", "bands"]), "classes")

    members = least.select("doc_id", F.explode("bands").alias("key"))
    buckets = members.groupBy("key").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high")
    members = scratch.keep(members.join(buckets.select("key", "low"), "key"), "members")
    starred = members.where("doc_id <> low").select(F.col("doc_id").alias("a"), F.col("low").alias("b")).distinct()

    signatures = least.select("doc_id", "signature")
    first = confirmed(scratch.keep(likely(starred, signatures, percent / 100), "likely"), docs, words, percent, scratch)
    edges = scratch.keep(same.unionAll(first), "edges")
    labels = connected_components(edges, scratch)

    placed = (
        members.where("doc_id <> low").join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        .select("key", "doc_id", F.coalesce("component", "doc_id").alias("component"))
    )
    mixed = placed.groupBy("key").agg(F.min("component").alias("one"), F.max("component").alias("other")).where(
        "one < other").select("key")
    left = scratch.keep(placed.join(mixed, "key", "left_semi"), "mixed")
    if left.take(1):
        crossing = _confirmed_in_blocks(left, least, docs, words, percent, scratch)
        labels = connected_components(edges.unionAll(crossing), scratch)
    scratch.drop(least, members, left)
    return (
        sketches.select("doc_id", "n_shingles")
        .join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
        .withColumn("kept", F.col("component_id").eqNullSafe(F.col("doc_id")))
    )


def without_near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80,
                            scratch: Scratch | None = None) -> DataFrame:
    """``docs`` without the documents that are not the first of their group, with their own columns.

    Rows that repeat a doc_id are one document and stay or go together; rows without doc_id stay.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    gone = scratch.keep(
        near_duplicates(docs, words, percent, scratch).where("NOT kept").select(F.col("doc_id").alias("__gone"))
        .distinct(), "gone")
    listed = F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone
    return docs.join(listed, F.col("doc_id").cast("long") == F.col("__gone"), "left_anti")
