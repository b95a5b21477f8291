"""Vector codes against plain integer k-means; bounds against all distances."""

import hashlib
import math

import numpy as np
import pytest

from newsmart.llm.codes import Shape, nearest, pack, unpack, vector_codes


def plain(rows, parts, entries, rounds, scale):
    """(codes, errors, digest) of (vec_id, label, vector) with Python's whole numbers."""
    kept = [r for r in rows if r[2] is not None and all(x is not None and math.isfinite(x) for x in r[2])]
    width = -(-max((len(v) for *_, v in kept), default=0) // parts)
    limit = Shape(parts, width).limit
    points = []
    for _, _, v in kept:
        whole = [min(max(math.floor(float(np.float32(x)) * scale), -limit), limit) for x in v]
        whole += [0] * (parts * width - len(whole))
        points.append([whole[p * width:(p + 1) * width] for p in range(parts)])
    order = sorted(range(len(kept)), key=lambda at: (kept[at][0] is None, kept[at][0] or 0, kept[at][2]))[:entries]
    books = [[points[at][p] for at in order] for p in range(parts)]

    def assign():
        return [[min(range(len(book)), key=lambda e: (sum((a - b) ** 2 for a, b in zip(point[p], book[e])), e))
                 for p, book in enumerate(books)] for point in points]

    for _ in range(rounds):
        own = assign()
        for p, book in enumerate(books):
            for e in range(len(book)):
                mine = [point[p] for point, code in zip(points, own) if code[p] == e]
                if mine:
                    book[e] = [sum(column) // len(mine) for column in zip(*mine)]
    own = assign()
    errors = [sum((a - b) ** 2 for p in range(parts) for a, b in zip(point[p], books[p][code[p]]))
              for point, code in zip(points, own)]
    digest = hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
    totals = {}
    for row, error in zip(kept, errors):
        totals[row[1]] = totals.get(row[1], 0) + error
    return sorted((repr(row[0]), "".join(f"{e:02x}" for e in code), error, totals[row[1]], digest)
                  for row, code, error in zip(kept, own, errors))


def some_rows(count, size, seed):
    draws = np.random.default_rng(seed)
    centres = draws.standard_normal((9, size))
    return [(int(at) * 3, int(at) % 4 or None, (centres[draws.integers(9)] + 0.3 * draws.standard_normal(size)).astype(
        np.float32).tolist()) for at in draws.permutation(count)]


@pytest.mark.parametrize("parts, entries, size", [(8, 16, 16), (3, 5, 10), (2, 300 // 2, 4)])
def test_codes_equal_plain_k_means(spark, parts, entries, size):
    rows = some_rows(400, size, parts)
    rows += [(9001, 1, None), (9002, 1, [math.nan] * size), (9003, 1, [None] * size), (9004, 1, [math.inf] + [0.0] * (size - 1)),
             (9005, 2, []), (9006, 2, [0.0] * size), (9007, None, [1.0]), (None, 3, rows[0][2]), rows[1], rows[1],
             (9008, 7, [1e30] * size), (-5, 7, [-1e30] * size)] + [(9100 + at, 8, rows[2][2]) for at in range(100)]
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").selectExpr(
        "*", "1 AS code", "2 AS error", "3 AS state", "4 AS vector").repartition(4)
    out = vector_codes(frame, parts, entries)
    assert out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    got = sorted((repr(r.vec_id), r.code, r.error, r.label_error, r.codebooks_sha256) for r in out.collect())
    assert got == plain(rows, parts, entries, 6, 4096)


def test_codes_of_few_and_no_vectors(spark):
    rows = [(1, "a", [1.0, 2.0]), (2, None, [1.5, -2.0]), (3, None, [1.0, 2.0])]
    schema = "vec_id long, label string, embedding array<float>"
    got = vector_codes(spark.createDataFrame(rows, schema), 2)
    assert sorted((repr(r.vec_id), r.code, r.error, r.label_error, r.codebooks_sha256) for r in got.collect()) == plain(
        rows, 2, 16, 6, 4096)
    one = vector_codes(spark.createDataFrame(rows[:1], schema)).collect()
    assert [(r.code, r.error) for r in one] == [("00" * 8, 0)]
    assert vector_codes(spark.createDataFrame([], schema)).collect() == []
    assert vector_codes(spark.createDataFrame([(1, "a", None)], schema)).collect() == []


def test_bounds_never_hide_a_nearer_entry():
    draws = np.random.default_rng(4)
    points = draws.integers(-30, 30, (3000, 4))  # small numbers, so that ties abound
    book, state, kept, settled = points[:12].copy(), None, 5, 0
    moves = None
    for turn in range(12):
        state, depths = nearest(points, book, state, moves, kept)
        apart = ((points[:, None, :] - book[None]) ** 2).sum(axis=2)
        assert (state[0][:, 0] == apart.argmin(axis=1)).all()
        near, up, low, outer = state
        exact = np.sqrt(apart)
        rows = np.arange(len(points))
        assert (up >= exact[rows, near[:, 0]]).all()
        assert (low <= exact[rows[:, None], near[:, 1:]]).all() and (np.diff(low, axis=1) >= 0).all()
        rest = np.ones_like(exact, bool)
        rest[rows[:, None], near] = False
        assert (np.where(rest, exact, np.inf) >= outer[:, None]).all()
        settled += turn > 0 and depths.sum() < len(points)
        packed = pack([state, state])
        for again in unpack(packed, [kept, kept]):
            assert all((a == b).all() for a, b in zip(again, state))
        new = np.array([points[near[:, 0] == e].mean(axis=0).round().astype(np.int64) if (near[:, 0] == e).any() else book[e]
                        for e in range(len(book))])
        moves = np.sqrt(((new - book) ** 2).sum(axis=1))
        book, kept = new, max(3, kept - (turn % 4 == 3))
    assert settled > 5  # most rounds leave some parts without any distance worked out
