"""Importance resampling against a plain version that hashes every run on its own."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from newsmart.llm import importance
from newsmart.llm.importance import payload_scanner, placed, resample, resampled, run_crcs, shifted
from newsmart.llm.scratch import Scratch

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return WORD.findall((text or "").translate(LOWER))


def crcs_of(text, fewest, most):
    words = words_of(text)
    return [zlib.crc32(" ".join(words[at:at + size]).encode()) for size in range(fewest, most + 1)
            for at in range(len(words) - size + 1)]


def brute(docs, target, percent, least, buckets, runs, seed):
    s, t = np.zeros(buckets, int), np.zeros(buckets, int)
    for counts, texts in ((s, [text for _, text in docs]), (t, target)):
        for text in texts:
            for crc in crcs_of(text, *runs):
                counts[crc % buckets] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.sum() + buckets) / ((s[b] + 1) * (t.sum() + buckets))))
            for b in range(buckets)]
    rows = []
    for doc_id, text in docs:
        crcs = crcs_of(text, *runs)
        weight = sum(gain[crc % buckets] for crc in crcs) // len(crcs) if crcs else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32)))
        rows.append((doc_id, len(crcs), weight, score, len(words_of(text)) >= least))
    enough = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    ranks = sorted((repr(r[:4]), place) for place, r in enumerate(enough[:percent * len(enough) // 100], 1))
    return sorted(repr(r[:4]) for r in rows), ranks


def texts(count, seed=3):
    draws = random.Random(seed)
    vocabulary = ["".join(draws.choices("abcdefgXYZ019éß中", k=draws.randrange(1, 9))) for _ in range(300)]
    return [draws.choice(" \t.,-_\n").join(draws.choices(vocabulary, k=draws.randrange(0, 80))) for _ in range(count)]


def test_payloads_compose_to_the_crcs_of_runs(monkeypatch):
    monkeypatch.setattr(importance, "STRETCH_BYTES", 300)
    monkeypatch.setattr(importance, "DICTIONARY_BYTES", 200)
    rows = [*texts(40), None, "", " -- ", "x" * 5000 + " y " + "z" * 700, "one " * 400, "\x01" + "1 a"]
    found = list(payload_scanner()((at, text) for at, text in enumerate(rows)))
    assert [key for key, _ in found] == list(range(len(rows)))
    for (_, payloads), text in zip(found, rows):
        assert (payloads >> np.uint64(32)).tolist() == [len(word.encode()) for word in words_of(text)]
        assert run_crcs(payloads, 1, 3).tolist() == crcs_of(text, 1, 3)
        assert run_crcs(payloads, 2, 2).tolist() == crcs_of(text, 2, 2)


def test_a_crc_is_shifted_by_any_length():
    lengths = [0, 1, 2, 255, 70_000]
    got = shifted(np.full(len(lengths), zlib.crc32(b"left"), np.uint64), np.array(lengths, np.uint64))
    want = [zlib.crc32(b"left" + bytes(size)) ^ zlib.crc32(bytes(size)) for size in lengths]
    assert got.tolist() == want


def test_resampling_equals_brute_force(spark):
    docs = list(enumerate(texts(150))) + [(7, "again " * 30), (7, "again " * 30), (None, "no id " * 30), (200, None),
                                          (201, ""), (202, "long " * 60_000), (203, "?!")]
    target = [text.upper() for text in texts(12)] + [None]
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr(
        "*", "1 AS score", "2 AS rank", "3 AS places", "4 AS bucket").repartition(5)
    wanted = spark.createDataFrame([(text, 1) for text in target], "text string, n int")
    for percent, runs, buckets in ((10, (1, 1), 10_000), (50, (1, 2), 70_000)):
        out = resample(frame, wanted, percent, 20, buckets, runs)
        assert out.columns == ["doc_id", "n_features", "weight", "score", "rank"]
        rows, ranks = brute(docs, target, percent, 20, buckets, runs, 2024)
        got = [(repr(tuple(r)[:4]), r.rank) for r in out.collect()]
        assert sorted(row for row, _ in got) == rows
        assert sorted((row, rank) for row, rank in got if rank is not None) == ranks
    kept = resampled(frame, wanted, 50)
    assert kept.columns == frame.columns and 0 < kept.count() < len(docs)


def test_resampling_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b " * 30)], "doc_id long, text string")
    assert resample(empty, some).collect() == []
    (row,) = resample(some, empty, percent=100).collect()
    assert (row.n_features, row["rank"]) == (60, 1)


def test_places_run_over_partitions(spark):
    rows = spark.range(5000).select((F.col("id") * 7919 % 13).alias("a"), "id")
    out = placed(rows, [F.desc("a"), F.asc("id")], Scratch(spark)).collect()
    assert [r.place for r in sorted(out, key=lambda r: (-r.a, r.id))] == list(range(1, 5001))
