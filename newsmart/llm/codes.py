"""Vector code compression: product codes from integer k-means, assigned with adaptive distance bounds.

Vectors become whole numbers and are cut into equal parts. Every part position has a codebook; rounds of assignment and
integer means train it, and a vector's code names the nearest entry of each part. All results are exact in whole numbers,
whatever the order of rows.

Assignment keeps, for each part of each vector, its b closest entries with lower bounds on their distances in order, one
outer bound for all other entries, and an upper bound on the distance to its own entry. When entries move, bounds move
by as much. An own entry whose upper bound stays below every lower bound is still the nearest; otherwise its distance is
worked out, and then those of the closest entries down to the first lower bound beyond it, or of all entries where the
outer bound does not exclude them. What decides is always the distance in whole numbers. b shrinks to the depth that the
last round's doubtful parts needed.

Bounds are stored beside the vectors, in single precision rounded outwards. A round reads and writes the table once and
moves one row of sums per task; codebooks, entries x dimension whole numbers, are all that the driver sees.
"""

from __future__ import annotations

import hashlib
import math
from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from .scratch import Scratch

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
BROADCAST_LABELS = 100_000  # rows of a label and a number
COVERED = 0.95  # of doubtful parts that the closest entries kept for the next round would have settled
SLACK = 1e-5  # more than the rounding error of adding a move to a bound


class Shape(NamedTuple):
    """How vectors are cut: number of parts, components in a part."""

    parts: int
    width: int

    @property
    def limit(self) -> int:
        """The largest component whose squared distances, summed over all parts, stay exact in 64 bits."""
        return 1 << min(30, (61 - math.ceil(math.log2(max(1, self.parts * self.width)))) // 2)


def finite(embeddings: DataFrame) -> DataFrame:
    """(vec_id, label, embedding) of the rows whose vector is there and has finite components only."""
    rows = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"))
    return rows.where(F.coalesce(F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False)))


def whole_numbers(rows: DataFrame, shape: Shape, scale: int) -> DataFrame:
    """(vec_id, label, vector): floor(scale * x) of each component as four bytes, filled up with zeros."""
    def convert(batches):
        import numpy as np
        import pyarrow as pa

        size = shape.parts * shape.width
        for batch in batches:
            out = []
            for values in batch.column("embedding"):
                vector = np.zeros(size, "<i4")
                whole = np.floor(np.asarray(values.values, np.float64) * scale)
                vector[:len(whole)] = np.clip(whole, -shape.limit, shape.limit)
                out.append(vector.tobytes())
            yield pa.record_batch([batch.column("vec_id"), batch.column("label"), pa.array(out, pa.binary())],
                                  names=["vec_id", "label", "vector"])

    return rows.mapInArrow(convert, "vec_id long, label string, vector binary")


def nearest(points, book, state, moves, keep: int):
    """(state, depths) of the parts ``points`` (n x width) for the entries ``book`` (k x width), whole numbers all.

    ``state`` is (near, up, low, outer) for the entries before they moved by ``moves``, or None: near (n x b) names the own
    entry and the next closest, low (n x b - 1) holds their lower bounds in order, up and outer one number a part. The new
    state keeps ``keep`` entries. ``depths`` counts, by how many of the closest entries it took, the doubtful parts, those
    settled by all entries at the end.
    """
    import numpy as np

    count, entries = len(points), len(book)
    above = lambda x: np.nextafter(x.astype(np.float32), np.float32(np.inf))
    below = lambda x: np.nextafter(x.astype(np.float32), np.float32(-np.inf))

    def squared(rows, names):
        """Squared distances of points[rows] to the entries ``names`` (rows x any)."""
        apart = points[rows][:, None, :] - book[names]
        return (apart * apart).sum(axis=2)

    if state is None:
        near, depths = np.zeros((count, keep), np.uint8), np.zeros(entries + 1, np.int64)
        up, low = np.zeros(count, np.float32), np.zeros((count, keep - 1), np.float32)
        outer, doubtful = np.full(count, -np.inf, np.float32), np.arange(count)
        whole = doubtful
    else:
        near, up, low, outer = state
        depths = np.zeros(entries + 1, np.int64)
        up = above(up.astype(np.float64) + moves[near[:, 0]] + SLACK)
        outer = below(outer.astype(np.float64) - moves.max() - SLACK)
        low = below(low.astype(np.float64) - moves[near[:, 1:]] - SLACK)
        low = np.minimum(np.minimum.accumulate(low[:, ::-1], axis=1)[:, ::-1], outer[:, None])
        first = low[:, 0] if low.shape[1] else outer
        doubtful = np.flatnonzero(up >= first)
        if len(doubtful):
            up[doubtful] = above(np.sqrt(squared(doubtful, near[doubtful, :1])[:, 0].astype(np.float64)))
            doubtful = doubtful[up[doubtful] >= first[doubtful]]
        whole = doubtful[up[doubtful] >= outer[doubtful]]
        some = doubtful[up[doubtful] < outer[doubtful]]
        if len(some):
            reach = (low[some] <= up[some, None]).sum(axis=1)  # bounds are in order, so these come first
            depths += np.bincount(reach, minlength=entries + 1)
            for depth in np.unique(reach):
                rows = some[reach == depth]
                names = near[rows, :depth + 1]
                apart = squared(rows, names)
                order = np.lexsort((names, apart), axis=1)
                near[rows, :depth + 1] = np.take_along_axis(names, order, 1)
                apart = np.sqrt(np.take_along_axis(apart, order, 1).astype(np.float64))
                up[rows] = above(apart[:, 0])
                low[rows, :depth] = below(apart[:, 1:])
            low[some] = np.minimum(np.minimum.accumulate(low[some][:, ::-1], axis=1)[:, ::-1], outer[some, None])
    if len(whole):
        depths[entries] += len(whole) if state is not None else 0
        held = near.shape[1]
        apart = squared(whole, np.arange(entries)[None, :].repeat(len(whole), axis=0))
        order = np.argsort(apart, axis=1, kind="stable")
        apart = np.sqrt(np.take_along_axis(apart, order, 1).astype(np.float64))
        near[whole], up[whole], low[whole] = order[:, :held], above(apart[:, 0]), below(apart[:, 1:held])
        outer[whole] = below(apart[:, held]) if held < entries else np.float32(np.inf)
    if keep < near.shape[1]:
        outer = np.minimum(outer, low[:, keep - 1])
        near, low = near[:, :keep], low[:, :keep - 1]
    return (near, up, low, outer), depths


def pack(states):
    """The states of all parts, one row of bytes a vector."""
    import numpy as np

    columns = []
    for near, up, low, outer in states:
        numbers = np.concatenate([up[:, None], low, outer[:, None]], axis=1).astype("<f4")
        columns += [np.ascontiguousarray(near), numbers.view(np.uint8).reshape(len(numbers), -1)]
    return np.concatenate(columns, axis=1)


def unpack(packed, kept: list[int]):
    """What ``pack`` packed, of parts that keep ``kept`` entries."""
    import numpy as np

    states, at = [], 0
    for b in kept:
        numbers = np.ascontiguousarray(packed[:, at + b:at + b + 4 * (b + 1)]).view("<f4").astype(np.float32)
        states.append((packed[:, at:at + b].copy(), numbers[:, 0].copy(), numbers[:, 1:-1].copy(), numbers[:, -1].copy()))
        at += b + 4 * (b + 1)
    return states


def assigned(table: DataFrame, shape: Shape, books: list, moves: list | None, held: list[int], kept: list[int]) -> DataFrame:
    """``table`` (vec_id, label, vector, state) with the state for ``books``, and one row of sums a task, whose vec_id, label,
    vector and state are null: for each part and entry its components' sums and count, then the part's depths."""
    def assign(batches):
        import numpy as np
        import pyarrow as pa

        def rows_of(column):
            return np.frombuffer(b"".join(x.as_buffer() for x in column), np.uint8).reshape(len(column), -1)

        entries, schema = len(books[0]), pa.schema([
            ("vec_id", pa.int64()), ("label", pa.string()), ("vector", pa.binary()), ("state", pa.binary()),
            ("code", pa.binary()), ("error", pa.int64()), ("sums", pa.list_(pa.int64()))])
        arrays = [np.array(book, np.int64).reshape(entries, shape.width) for book in books]
        sums = np.zeros((shape.parts, entries, shape.width + 1), np.int64)
        depths = np.zeros((shape.parts, entries + 1), np.int64)
        for batch in batches:
            batch = batch.filter(batch.column("vector").is_valid())
            for start in range(0, batch.num_rows, 4096):
                part = batch.slice(start, 4096)
                points = rows_of(part.column("vector")).view("<i4").reshape(-1, shape.parts, shape.width).astype(np.int64)
                before = unpack(rows_of(part.column("state")), held) if moves else [None] * shape.parts
                states, error = [], np.zeros(len(points), np.int64)
                for at, book in enumerate(arrays):
                    state, depth = nearest(points[:, at], book, before[at], np.array(moves[at]) if moves else None, kept[at])
                    own = state[0][:, 0]
                    depths[at] += depth
                    for dimension in range(shape.width):
                        np.add.at(sums[at, :, dimension], own, points[:, at, dimension])
                    sums[at, :, -1] += np.bincount(own, minlength=entries)
                    apart = points[:, at] - book[own]
                    error += (apart * apart).sum(axis=1)
                    states.append(state)
                code = np.stack([state[0][:, 0] for state in states], axis=1)
                none = pa.array([None] * len(points), pa.list_(pa.int64()))
                yield pa.record_batch(
                    [part.column("vec_id"), part.column("label"), part.column("vector"),
                     pa.array([row.tobytes() for row in pack(states)], pa.binary()),
                     pa.array([row.tobytes() for row in code], pa.binary()), pa.array(error), none], schema=schema)
        told = np.concatenate([sums.reshape(-1), depths.reshape(-1)]).tolist()
        yield pa.record_batch([*(pa.array([None], kind) for kind in schema.types[:-1]), pa.array([told], schema.types[-1])],
                              schema=schema)

    return table.select("vec_id", "label", "vector", "state").mapInArrow(
        assign, "vec_id long, label string, vector binary, state binary, code binary, error long, sums array<long>")


def _totals(table: DataFrame, shape: Shape, entries: int) -> tuple[list, list]:
    """Sums by part and entry, and depths by part, added up over tasks; their number depends on the codebooks alone."""
    added = table.where("sums IS NOT NULL").select(F.posexplode("sums").alias("at", "n")).groupBy("at").agg(
        F.sum(F.col("n").cast("decimal(38,0)")).alias("n")).collect()
    flat = [int(row.n) for row in sorted(added)]
    size, split = shape.width + 1, shape.parts * entries * (shape.width + 1)
    sums = [[flat[(part * entries + entry) * size:(part * entries + entry + 1) * size] for entry in range(entries)]
            for part in range(shape.parts)]
    return sums, [flat[split + part * (entries + 1):split + (part + 1) * (entries + 1)] for part in range(shape.parts)]


def _moved(books: list, sums: list) -> list:
    """Entries at the floored means of their parts; unused ones stay."""
    return [[[total // row[-1] for total in row[:-1]] if row[-1] else entry for entry, row in zip(book, part)]
            for book, part in zip(books, sums)]


def _shrunk(kept: list[int], depths: list, least: int) -> list[int]:
    """How many closest entries each part keeps: enough for most of the doubtful parts that they settled."""
    out = []
    for b, counts in zip(kept, depths):
        settled, so_far, depth = sum(counts[:-1]), 0, 0
        for depth, number in enumerate(counts[:-1]):
            so_far += number
            if so_far >= COVERED * settled:
                break
        out.append(min(b, max(least, depth + 1)))
    return out


class Codes(NamedTuple):
    """Codebooks by part and entry, and (vec_id, label, code, error): entries by part as bytes, summed squared distance."""

    codebooks: list
    codes: DataFrame

    def digest(self) -> str:
        numbers = (str(x) for book in self.codebooks for entry in book for x in entry)
        return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def compress(embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
             scratch: Scratch | None = None) -> Codes:
    """Codebooks trained on all vectors and every vector's code. Codebooks begin as the parts of the vectors with the
    ``entries`` least vec_ids, ties by components; with fewer vectors they are as short."""
    scratch = scratch or Scratch(embeddings.sparkSession)
    rows = finite(embeddings)
    longest = rows.agg(F.max(F.size("embedding"))).first()[0] or 0
    shape = Shape(parts, -(-longest // parts))
    table = scratch.keep(whole_numbers(rows, shape, scale).withColumn("state", F.lit(None).cast("binary")), "vectors")
    seeds = rows.orderBy(F.asc_nulls_last("vec_id"), "embedding").limit(entries).collect()  # the entries, no more
    seeds = [[min(max(math.floor(x * scale), -shape.limit), shape.limit) for x in row.embedding] for row in seeds]
    seeds = [seed + [0] * (parts * shape.width - len(seed)) for seed in seeds]
    books = [[seed[at * shape.width:(at + 1) * shape.width] for seed in seeds] for at in range(parts)]
    if not seeds:
        return Codes(books, table.select("vec_id", "label", F.lit(None).cast("binary").alias("code"),
                                         F.lit(None).cast("long").alias("error")))
    kept = [min(len(seeds), 1 + max(1, entries // 4))] * parts
    moves, held = None, kept
    for turn in range(rounds + 1):
        done = scratch.keep(assigned(table, shape, books, moves, held, kept), "assigned")
        scratch.drop(table)
        table = done
        if turn < rounds:
            sums, depths = _totals(table, shape, len(seeds))
            new = _moved(books, sums)
            moves = [[math.dist(a, b) for a, b in zip(book, after)] for book, after in zip(books, new)]
            books, held = new, kept
            if turn:
                kept = _shrunk(kept, depths, min(len(seeds), 1 + max(1, entries // 8)))
    return Codes(books, table.where("code IS NOT NULL").select("vec_id", "label", "code", "error"))


def vector_codes(embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
                 scale: int = SCALE, scratch: Scratch | None = None) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) for every usable row of ``embeddings`` (vec_id, embedding, label).

    ``code`` writes each part's entry as two hex digits; label_error sums errors over rows of equal label, nulls together.
    Defined cases: rows whose vector is null or holds null or non-finite components are left out. Vectors shorter than the
    longest, and lengths that parts do not divide, are filled up with zeros; an empty vector is all zeros. Components beyond
    ``Shape.limit`` after scaling are held there, so that distances stay exact (|x| under 4,096 always fits at up to
    1,024 components). Repeated rows and repeated vec_ids are vectors each; rows without vec_id come last among seeds.
    Ties go to the lesser entry. A sum of errors beyond 64 bits is the largest long. Other columns are ignored; an empty
    table gives no rows.
    """
    made = compress(embeddings, parts, entries, rounds, scale, scratch)
    most = F.lit((1 << 63) - 1).cast("decimal(38,0)")
    totals = made.codes.groupBy("label").agg(
        F.least(F.sum(F.col("error").cast("decimal(38,0)")), most).cast("long").alias("label_error"))
    totals = totals.withColumnRenamed("label", "of_label")
    if totals.count() <= BROADCAST_LABELS:
        totals = F.broadcast(totals)
    return made.codes.join(totals, F.col("label").eqNullSafe(F.col("of_label"))).select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(made.digest()).alias("codebooks_sha256"))
