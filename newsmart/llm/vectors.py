"""Near-duplicate embeddings: random-hyperplane signatures, exact cosine, connected components.

Equal vectors form a class, and only classes are compared. Each of several tables puts the classes into buckets by the
signs of their products with random hyperplanes. Members of a bucket are compared exactly, in blocks of bounded size:
a large bucket becomes many pairs of blocks, each a group of its own. A pair counts in the first table in which it
meets, so links are counted without listing pairs; a block pair returns, per vector, a count and one spanning link.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from .components import connected_components
from .groups import gathered, runs
from .scratch import Scratch

BLOCK = 2048


def usable(embedding: Column) -> Column:
    """Whether a vector can be compared: present, finite in all components, and not zero."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(embedding, lambda x: x != 0), F.lit(False))


def table_plan(vectors: int, similarity: float, recall: float) -> tuple[int, int]:
    """Bits per table and number of tables.

    Bits grow with the logarithm of the number of vectors, so that buckets of unrelated vectors keep their size; a
    pair at ``similarity`` meets in one of the tables with probability ``recall``.
    """
    bits = max(8, math.ceil(math.log2(max(vectors, 1) / 64)))
    together = (1 - math.acos(similarity) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - together))


def _signed(classes: DataFrame, bits: int, tables: int) -> DataFrame:
    """Adds ``buckets``, one signature per table. Planes are drawn for each dimension from one seed."""
    def sign(batches):
        import numpy as np
        import pyarrow as pa

        planes = {}
        weights = 1 << np.arange(bits, dtype=np.int64)
        for batch in batches:
            vectors = [np.asarray(x, np.float64) for x in batch.column("embedding").to_pylist()]
            out = []
            for vector in vectors:
                size = len(vector)
                if size not in planes:
                    planes[size] = np.random.default_rng(size).standard_normal((tables * bits, size))
                out.append((planes[size] @ vector > 0).reshape(tables, bits) @ weights)
            yield batch.append_column("buckets", pa.array(out, pa.list_(pa.int64())))

    return classes.mapInArrow(
        sign, "class_id long, vec_id long, copies long, embedding array<float>, buckets array<long>")


def _compare(blocks: DataFrame, similarity: float) -> DataFrame:
    """(class_id, vec_id, links, root) from rows (class_id, vec_id, copies, embedding, buckets, at, bucket, one, other, mine)."""
    def compare(batches):
        import numpy as np
        import pyarrow as pa

        for run in runs(batches, "at", "bucket", "one", "other"):
            classes, ids, copies, mine = (
                run.column(name).to_numpy() for name in ("class_id", "vec_id", "copies", "mine"))
            size = len(run.column("embedding")[0])
            vectors = run.column("embedding").combine_chunks().flatten().to_numpy().reshape(-1, size).astype(np.float64)
            vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
            at, diagonal = run.column("at")[0].as_py(), run.column("one")[0] == run.column("other")[0]
            here = mine == run.column("one")[0].as_py()
            left = np.flatnonzero(here)
            right = left if diagonal else np.flatnonzero(~here)
            close = vectors[left] @ vectors[right].T >= similarity
            a, b = np.nonzero(np.triu(close, 1) if diagonal else close)
            a, b = left[a], right[b]
            if at and len(a):
                seen = np.stack([row[:at] for row in
                                 run.column("buckets").combine_chunks().flatten().to_numpy().reshape(len(ids), -1)])
                new = np.concatenate([
                    ~(seen[a[i:i + 65536]] == seen[b[i:i + 65536]]).any(axis=1) for i in range(0, len(a), 65536)])
                a, b = a[new], b[new]
            if not len(a):
                continue
            links = np.bincount(a, copies[b], len(ids)) + np.bincount(b, copies[a], len(ids))
            order = np.argsort(ids, kind="stable")
            rank = np.empty(len(ids), np.int64)
            rank[order] = np.arange(len(ids))
            label = rank.copy()
            while True:
                least = np.minimum(label[a], label[b])
                before = label.copy()
                np.minimum.at(label, a, least)
                np.minimum.at(label, b, least)
                label = np.minimum(label, label[order[label]])
                if (label == before).all():
                    break
            touched = np.flatnonzero(links)
            yield pa.record_batch(
                [pa.array(classes[touched]), pa.array(ids[touched]), pa.array(links[touched].astype(np.int64)),
                 pa.array(ids[order[label[touched]]])], names=["class_id", "vec_id", "links", "root"])

    return gathered(blocks, "at", "bucket", "one", "other").mapInArrow(
        compare, "class_id long, vec_id long, links long, root long")


def near_vectors(embeddings: DataFrame, similarity: float = 0.95, recall: float = 0.9999, block: int = BLOCK,
                 scratch: Scratch | None = None) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``embeddings`` (vec_id, embedding: array<float>).

    Defined cases: vectors that are null, empty, zero, or hold null or non-finite components link with nothing, as do
    vectors of different length and rows without vec_id (whose component is null). Every other row is a vector,
    repeated ones too: equal rows link with each other. Other columns are ignored; an empty table gives no rows.
    """
    scratch = scratch or Scratch(embeddings.sparkSession)
    vectors = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>").alias("embedding"))
    compared = F.when(usable(F.col("embedding")) & F.col("vec_id").isNotNull(), F.col("embedding"))
    vectors = vectors.withColumn("embedding", compared)
    classes = scratch.keep(
        vectors.where("embedding IS NOT NULL").groupBy("embedding")
        .agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies"))
        .select(F.monotonically_increasing_id().alias("class_id"), "vec_id", "copies", "embedding"), "classes")
    signed = scratch.keep(_signed(classes, *table_plan(classes.count(), similarity, recall)), "signed")

    slim = signed.select(
        "class_id", (F.pmod(F.xxhash64("class_id", F.lit("block")), F.lit(1 << 30))).alias("draw"),
        F.size("embedding").alias("dimension"), F.posexplode("buckets").alias("at", "bucket"))
    sizes = slim.groupBy("at", "dimension", "bucket").count().where("count > 1").select(
        "at", "dimension", "bucket", F.ceil(F.col("count") / block).alias("blocks"))
    mine = F.pmod("draw", "blocks").cast("int")
    pairs = F.transform(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int")), lambda j: F.struct(
        F.least("mine", j).alias("one"), F.greatest("mine", j).alias("other")))
    met = slim.join(sizes, ["at", "dimension", "bucket"]).withColumn("mine", mine).select(
        "class_id", F.struct("at", "bucket", "mine", pairs.alias("pairs")).alias("meeting"))
    blocks = (
        signed.join(met.groupBy("class_id").agg(F.collect_list("meeting").alias("meetings")), "class_id")
        .select("class_id", "vec_id", "copies", "embedding", "buckets", F.explode("meetings").alias("m"))
        .select("class_id", "vec_id", "copies", "embedding", "buckets", "m.at", "m.bucket", "m.mine",
                F.explode("m.pairs").alias("p"))
        .select("class_id", "vec_id", "copies", "embedding", "buckets", "at",
                # vectors of different length never share a block
                F.xxhash64("bucket", F.size("embedding")).alias("bucket"), "mine", "p.one", "p.other")
    )
    found = scratch.keep(_compare(blocks, similarity), "found")
    labels = connected_components(found.select(F.col("vec_id").alias("a"), F.col("root").alias("b")), scratch)
    counted = found.groupBy("class_id").agg(F.sum("links").alias("links"))
    described = (
        classes.join(counted, "class_id", "left").join(labels.withColumnRenamed("node", "vec_id"), "vec_id", "left")
        .select("embedding", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                F.coalesce("component", "vec_id").alias("component_id"))
    )
    return (
        vectors.join(described, "embedding", "left")
        .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                F.coalesce("component_id", "vec_id").alias("component_id"))
        .withColumn("kept", F.col("component_id").eqNullSafe(F.col("vec_id")))
    )
