"""Components, near-duplicate documents and vectors, neighbours: against brute force."""

import itertools
import random

import numpy as np
import pytest

from newsmart.llm import hnsw
from newsmart.llm.components import connected_components
from newsmart.llm.minhash import near_duplicates, without_near_duplicates
from newsmart.llm.neighbours import build_index, nearest_neighbours, search_index
from newsmart.llm.scratch import Scratch
from newsmart.llm.shingles import shingle_set
from newsmart.llm.vectors import near_vectors


def least_reachable(nodes, links):
    root = {node: node for node in nodes}

    def find(node):
        while root[node] != node:
            node = root[node]
        return node

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {node: find(node) for node in nodes}


@pytest.mark.parametrize("shape", ["random", "chain", "star", "empty"])
def test_components(spark, shape):
    draws = random.Random(3)
    links = {
        "random": [(draws.randrange(200), draws.randrange(200)) for _ in range(150)],
        "chain": [(at, at + 1) for at in range(60)], "star": [(5, at) for at in range(100)], "empty": [],
    }[shape]
    frame = spark.createDataFrame(links + [(None, 1), (7, 7)], "a long, b long")
    got = {row.node: row.component for row in connected_components(frame, Scratch(spark)).collect()}
    real = [link for link in links if link[0] != link[1]]
    assert got == least_reachable({node for link in real for node in link}, real)


def test_shingles_follow_the_definition():
    assert len(shingle_set("a b a b a", 2)) == 2
    assert (shingle_set("A\tB\nc", 2) == shingle_set("a b  C", 2)).all()
    assert len(shingle_set("one", 2)) == len(shingle_set("one two", 5)) == 1
    assert len(shingle_set(" \n\t", 2)) == len(shingle_set(None, 2)) == 0
    assert (shingle_set("É x", 1) != shingle_set("é x", 1)).any()  # only A-Z is lower-cased
    assert len(shingle_set("a b c", 1)) == 2  # no-break space is no word end


def brute_duplicates(rows, words, percent):
    sets = [(doc_id, set(shingle_set(text, words).tolist())) for doc_id, text in rows]
    links = [
        (a, b) for (a, x), (b, y) in itertools.combinations([row for row in sets if row[0] is not None], 2)
        if x and y and 100 * len(x & y) >= percent * len(x | y)]
    reach = least_reachable({a for a, _ in sets if a is not None}, links)
    return sorted((str(a), len(x), str(reach.get(a)), a is None or reach[a] == a) for a, x in sets)


def noisy(draws, words, share):
    return " ".join(draws.choice("abcdefgh") * 3 if draws.random() < share else word for word in words)


@pytest.mark.parametrize("words", [2, 5])
def test_near_duplicates(spark, words):
    draws = random.Random(words)
    bases = [[str(draws.randrange(5000)) for _ in range(draws.randrange(3, 120))] for _ in range(12)]
    # Groups around each base, some just above and some just below the threshold.
    rows = [(at, noisy(draws, draws.choice(bases), draws.choice([0, 0.01, 0.04, 0.08]))) for at in range(250)]
    rows += [(300, None), (301, ""), (302, " \n"), (None, rows[0][1]), (None, None), (303, "word"), (304, "word"),
             (5, rows[9][1]), (5, rows[5][1]), (400, "x " * 30_000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "doc_id", "text", "1 AS component_id", "2 AS kept", "3 AS key")
    got = near_duplicates(frame, words=words).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in got) == \
        brute_duplicates(rows, words, 80)
    assert without_near_duplicates(frame, words=words).columns == frame.columns


def test_near_duplicates_of_nothing(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(frame).collect() == []
    assert without_near_duplicates(frame).collect() == []


def unit(vector):
    return np.asarray(vector, np.float32).astype(float).tolist()


def brute_vectors(rows, least):
    def good(v):
        return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    def near(v, w):
        v, w = np.asarray(v, float), np.asarray(w, float)
        return len(v) == len(w) and v @ w / np.sqrt((v @ v) * (w @ w)) >= least

    usable = [(at, name, v) for at, (name, v) in enumerate(rows) if name is not None and good(v)]
    pairs = [(a, b) for a, b in itertools.combinations(usable, 2) if near(a[2], b[2])]
    count = [0] * len(rows)
    for a, b in pairs:
        count[a[0]] += 1
        count[b[0]] += 1
    reach = least_reachable({name for name, _ in rows if name is not None}, [(a[1], b[1]) for a, b in pairs])
    return sorted((str(name), count[at], str(reach.get(name)), reach.get(name) == name)
                  for at, (name, _) in enumerate(rows))


@pytest.mark.parametrize("block", [4, 2048])
def test_near_vectors(spark, block):
    draws = np.random.default_rng(block)
    centres = draws.standard_normal((8, 16))
    rows = [(at, unit(centres[draws.integers(8)] + draws.standard_normal(16) * draws.choice([0.05, 0.15, 0.3])))
            for at in range(160)]
    same = unit(centres[0])
    rows += [(200 + at, same) for at in range(30)] + [(230, unit(2 * centres[0]))]
    rows += [(300, None), (301, [0.0] * 16), (302, [float("nan")] * 16), (303, [1.0, None] + [0.0] * 14),
             (304, [float("inf")] + [0.0] * 15), (305, []), (306, same[:8]), (307, same[:8]), (310, same), (310, same)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr(
        "*", "1 AS label", "2 AS bucket", "3 AS copies")
    got = near_vectors(frame, block=block, recall=1 - 1e-7).collect()
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in got) == brute_vectors(rows, 0.95)


def test_near_vectors_of_nothing(spark):
    assert near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


def brute_neighbours(vectors, names, k):
    scores = vectors.astype(float) @ vectors.astype(float).T
    return {name: [names[j] for j in np.lexsort((names, -scores[i])) if names[j] != name][:k]
            for i, name in enumerate(names)}


def test_neighbours_reach_nine_in_ten(spark):
    draws = np.random.default_rng(1)
    vectors = (draws.standard_normal((3000, 24)) * draws.uniform(0.5, 2, (3000, 1))).astype(np.float32)
    vectors[2500:] = vectors[7]  # a common vector
    names = np.arange(3000)
    frame = spark.createDataFrame([(int(n), v.tolist()) for n, v in zip(names, vectors)],
                                  "vec_id long, embedding array<float>")
    index, shards = build_index(frame, Scratch(spark), shard_rows=700)
    asked = frame.where("vec_id % 20 = 0")
    got = {}
    for row in search_index(index, shards, asked).orderBy("query_id", "rank").collect():
        got.setdefault(row.query_id, []).append((row.vec_id, row.score))
    want = brute_neighbours(vectors, names, 20)
    assert set(got) == set(range(0, 3000, 20)) and all(len(x) == 20 for x in got.values())
    hits = [len({v for v, _ in found} & set(want[name])) / 20 for name, found in got.items()]
    assert np.mean(hits) >= 0.9
    for name, found in got.items():
        assert found == sorted(found, key=lambda x: (-x[1], x[0]))
        assert all(abs(s - vectors[name].astype(float) @ vectors[v].astype(float)) < 1e-9 for v, s in found)


def test_neighbours_where_there_are_few(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]),
            (6, [1.0]), (7, [2.0]), (None, [1.0, 1.0]), (0, [1.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS shard", "2 AS rank")
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in nearest_neighbours(frame, frame).collect())
    assert got == [(0, 1, 1, 1.0), (0, 2, 2, 0.0), (1, 1, 0, 1.0), (1, 2, 2, 0.0), (2, 1, 0, 0.0), (2, 2, 1, 0.0),
                   (6, 1, 7, 2.0), (7, 1, 6, 2.0)]
    assert nearest_neighbours(frame.limit(0), frame.limit(0)).collect() == []


@pytest.mark.parametrize("size", [1, 2, 33, 90])
def test_small_graphs_are_connected(size):
    vectors = np.random.default_rng(size).standard_normal((size, 8)).astype(np.float32)
    found = hnsw.search(vectors, hnsw.build(vectors), vectors[:1], 128)
    assert set(found[0][found[0] >= 0]) == set(range(size))
