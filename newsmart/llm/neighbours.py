"""Approximate nearest neighbours by largest inner product: one graph per shard, shard results merged.

The index is a table with one row per shard: vectors, ids and the graph's layers as flat arrays. Every vector is
indexed. Equal vectors are one node, which lists the least ids that hold it, as many as an answer can need; so a vector
with a third of all rows neither fills a shard nor distorts its graph.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .groups import gathered, runs
from .hnsw import BREADTH, LINKS, build as build_graph, search as search_graph
from .scratch import Scratch
from .vectors import usable

SHARD_ROWS = 8192
QUERY_BLOCK = 1024
SEARCH_BREADTH = 200

_INDEX = ("shard long, dimension int, vectors binary, owners binary, ids binary, "
          "layers array<struct<nodes: binary, links: binary>>")


def _rows(embeddings: DataFrame) -> DataFrame:
    rows = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>").alias("embedding"))
    return rows.where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))


def build_index(embeddings: DataFrame, scratch: Scratch, k: int = 20, shard_rows: int = SHARD_ROWS, links: int = LINKS,
                breadth: int = BREADTH) -> tuple[DataFrame, int]:
    """The index of all usable vectors, and its number of shards per dimension.

    A node keeps its k + 1 least ids: an answer of k without the query's own row never needs more.
    """
    least = Window.partitionBy("embedding").orderBy("vec_id")
    nodes = scratch.keep(
        _rows(embeddings).distinct().withColumn("at", F.row_number().over(least)).where(F.col("at") <= k + 1)
        .groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "nodes")
    shards = max(1, -(-nodes.count() // shard_rows))

    def build(batches):
        import numpy as np
        import pyarrow as pa

        for run in runs(batches, "shard"):
            run = run.take(np.argsort([ids[0].as_py() for ids in run.column("ids")], kind="stable"))
            size = len(run.column("embedding")[0])
            vectors = run.column("embedding").combine_chunks().flatten().to_numpy().reshape(-1, size)
            members = run.column("ids").to_pylist()
            owners = np.repeat(np.arange(len(members)), [len(ids) for ids in members])
            layers = build_graph(vectors, links, breadth)
            yield pa.record_batch([
                run.column("shard").combine_chunks()[:1], pa.array([size], pa.int32()),
                pa.array([vectors.astype("<f4").tobytes()]), pa.array([owners.astype("<i4").tobytes()]),
                pa.array([np.concatenate(members).astype("<i8").tobytes()]),
                pa.array([[{"nodes": held.astype("<i4").tobytes(), "links": near.astype("<i4").tobytes()}
                           for held, near in layers]],
                         pa.list_(pa.struct([("nodes", pa.binary()), ("links", pa.binary())])))],
                names=["shard", "dimension", "vectors", "owners", "ids", "layers"])

    # Vectors of one dimension share shards; the dimension is the shard number's upper half.
    shard = F.pmod(F.xxhash64("embedding"), F.lit(shards)) + F.size("embedding").cast("long") * (1 << 32)
    index = scratch.keep(
        gathered(nodes.withColumn("shard", shard), "shard").mapInArrow(build, _INDEX), "index")
    scratch.drop(nodes)
    return index, shards


def search_index(index: DataFrame, shards: int, queries: DataFrame, k: int = 20,
                 breadth: int = SEARCH_BREADTH) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best by score, then vec_id, its own id left out.

    Queries (vec_id, embedding) go to every shard in blocks; a block and a shard are one group, which holds the
    shard's graph and the block. Scores are exact, in double precision, on the vectors as they are.
    """
    asked = _rows(queries).dropDuplicates(["vec_id", "embedding"])
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    empty = {name: kind for name, kind in index.dtypes if name != "shard"}
    asked = asked.select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("at"), "vec_id", "embedding").select(
        (F.col("at") + F.size("embedding").cast("long") * (1 << 32)).alias("shard"),
        F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"), F.lit(1).alias("kind"),
        "vec_id", "embedding", *(F.lit(None).cast(kind).alias(name) for name, kind in empty.items()))
    graphs = index.select(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(0).alias("kind"),
        F.lit(None).cast("long").alias("vec_id"), F.lit(None).cast("array<float>").alias("embedding"), *empty)

    def find(batches):
        import numpy as np
        import pyarrow as pa

        for run in runs(batches, "shard", "block"):
            kinds = run.column("kind").to_numpy()
            if kinds.min() or not kinds.max():
                continue  # no vectors of this dimension here, or no queries
            graph = run.slice(int(np.argmin(kinds)), 1).to_pylist()[0]
            size = graph["dimension"]
            vectors = np.frombuffer(graph["vectors"], "<f4").reshape(-1, size)
            owners, ids = np.frombuffer(graph["owners"], "<i4"), np.frombuffer(graph["ids"], "<i8")
            starts = np.searchsorted(owners, np.arange(len(vectors) + 1))
            layers = [(np.frombuffer(x["nodes"], "<i4"), np.frombuffer(x["links"], "<i4").reshape(len(x["nodes"]) // 4, -1))
                      for x in graph["layers"]]
            mine = run.filter(pa.array(kinds == 1))
            names = mine.column("vec_id").to_numpy()
            points = mine.column("embedding").combine_chunks().flatten().to_numpy().reshape(-1, size)
            found = search_graph(vectors, layers, points, max(breadth, k + 1))
            out = [[], [], []]
            for name, point, near in zip(names, points.astype(np.float64), found):
                near = near[near >= 0]
                scores = (vectors[near].astype(np.float64) * point).sum(axis=1)
                enough = np.argsort(-scores, kind="stable")
                # Nodes that tie with the last one needed stay, so that ties are settled by id.
                enough = enough[scores[enough] >= scores[enough[min(k, len(enough) - 1)]]]
                hits = np.concatenate([ids[starts[near[at]]:starts[near[at] + 1]] for at in enough])
                marks = np.repeat(scores[enough], [starts[near[at] + 1] - starts[near[at]] for at in enough])
                other = hits != name
                hits, marks = hits[other], marks[other]
                best = np.lexsort((hits, -marks))[:k]
                for column, values in zip(out, (np.full(len(best), name), hits[best], marks[best])):
                    column.append(values)
            yield pa.record_batch([pa.array(np.concatenate(column)) for column in out],
                                  names=["query_id", "vec_id", "score"])

    hits = gathered(asked.unionByName(graphs), "shard", "block").mapInArrow(
        find, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def nearest_neighbours(embeddings: DataFrame, queries: DataFrame, k: int = 20, breadth: int = SEARCH_BREADTH,
                       scratch: Scratch | None = None) -> DataFrame:
    """The k nearest rows of ``embeddings`` per row of ``queries`` (vec_id, embedding), found through the index.

    Defined cases: vectors that are null, empty, zero, or hold null or non-finite components take no part, nor do
    rows without vec_id; vectors of different length are never near. Repeated rows count once. With fewer than k
    candidates all are returned; an empty table gives no rows. Other columns are ignored.
    """
    scratch = scratch or Scratch(embeddings.sparkSession)
    index, shards = build_index(embeddings, scratch, k)
    return search_index(index, shards, queries, k, breadth)
