"""Packing, archives, lines, mixing, placement, language, quality."""

import itertools
import random
import struct
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from newsmart.llm.language import fit, identified, identify
from newsmart.llm.mixing import mix, sampled
from newsmart.llm.packing import fill_window, fillings, place_pieces
from newsmart.llm.placement import fill_table, place_documents
from newsmart.llm.quality import compiled, featurized, learn, quality_scores, shares
from newsmart.llm.queries import pack_with_public_tokenizer
from newsmart.llm.rules import holds
from newsmart.llm.scratch import Scratch, fresh_path
from newsmart.llm.warc import DICTIONARY_MAGIC, archive_pages, link_revisits, read_archives, write_archives

SF = "/root/testdata/sf0.001"


def test_a_window_is_filled_as_well_as_can_be():
    draws = random.Random(1)
    for _ in range(200):
        lengths = [draws.randrange(1, 40) for _ in range(draws.randrange(1, 9))]
        counts = {length: lengths.count(length) for length in lengths}
        filling = fill_window(counts, 50)
        first = max(lengths)
        rest = list(lengths)
        rest.remove(first)
        best = max(first + sum(some) for size in range(len(rest) + 1) for some in itertools.combinations(rest, size)
                   if first + sum(some) <= 50)
        assert sum(length * number for length, number in filling.items()) == best
        assert all(number <= counts[length] for length, number in filling.items())


def test_fillings_use_every_piece():
    counts = {700: 10, 300: 25, 24: 30, 1: 3, 1024: 2}
    used = dict.fromkeys(counts, 0)
    for filling, times in fillings(counts, 1024):
        assert sum(length * number for length, number in filling.items()) <= 1024
        for length, number in filling.items():
            used[length] += times * number
    assert used == counts and fillings({}, 1024) == []


def test_packing_is_whole_and_tight(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").toPandas()
    extra = [(1000, None), (1001, ""), (1002, "a <|endoftext|> b  c"), (None, "no id"), (1003, "same"), (1003, "same"),
             (1004, "long " * 60_000), (1005, " " * 2_000_000), (1006, "a" + "\n" * 1_000_000 + "b"), (1007, "\t" * 1_200_000),
             (1008, "x " + "\r\n" * 600_000 + " y"), (1009, " " * 9_999 + "z" + " " * 10_000), (1010, "\u3000" * 700_000)]
    rows = [*docs.itertuples(index=False, name=None), *extra]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS start", "2 AS offset")
    out = pack_with_public_tokenizer(frame).toPandas()
    full = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = []
    for doc_id, text in rows:
        ids = np.array([*full.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        want += [(str(doc_id), at, len(ids[at:at + 1024]), zlib.crc32(ids[at:at + 1024].tobytes()), len(ids))
                 for at in range(0, len(ids), 1024)]
    got = [("None" if pd.isna(a) else str(int(a)), *rest) for a, *rest in
           out[["doc_id", "start", "length", "ids_crc32", "doc_tokens"]].itertuples(index=False, name=None)]
    assert sorted(map(tuple, got)) == sorted(want)
    for _, part in out.sort_values("offset").groupby("sequence_id"):
        assert part.offset.tolist() == [0, *part.length.cumsum().tolist()[:-1]] and part.length.sum() <= 1024
    used = out.groupby("sequence_id").length.sum()
    assert (1024 - used).sum() < 0.02 * used.sum()


def test_packing_of_nothing_and_shards(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert pack_with_public_tokenizer(empty).collect() == []
    many = spark.range(3000).select(((F.col("id") * 7919) % 1024 + 1).alias("length"))
    placed = place_pieces(many, Scratch(spark), shard_pieces=100).toPandas()
    assert sorted(placed.length) == sorted((at * 7919) % 1024 + 1 for at in range(3000))
    assert placed.groupby("sequence_id").length.sum().max() <= 1024


PAGES = [(1, "http://a/ b", "x" * 150), (2, None, "x" * 150), (3, "", "y" * 99), (4, "u", "y" * 99), (5, "u", None),
         (6, "u", ""), (None, "u", "x" * 150), (0, "u", "é" * 5000), (9, "u", "é" * 5000), (9, "u", "é" * 5000),
         (8, "line\r\nbreak", "<p>\r\n\r\n</p>" * 20)]


def test_archives_round_trip(spark):
    frame = spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr(
        "*", "1 AS key", "2 AS payload", "3 AS refers_to")
    got = {(r.page_id, r.record_type, r.refers_to, r.payload_bytes, bytes(r.payload) if r.payload is not None else None)
           for r in archive_pages(frame, payloads=True).collect()}
    want = set()
    for page, _, html in PAGES:
        payload = (html or "").encode()
        first = {150: 1, 10000: 0}.get(len(payload), page)
        revisit = page is not None and page != first
        want.add((page, "revisit" if revisit else "response", first if revisit else None, len(payload),
                  None if revisit else payload))
    assert got == want
    assert archive_pages(frame.limit(0)).collect() == []


def test_archives_begin_with_their_dictionary(spark):
    import zstandard

    pages = spark.read.parquet(f"{SF}/pages.parquet")
    folder, scratch = fresh_path(spark, "warc"), Scratch(spark)
    listing = write_archives(link_revisits(pages).repartition(2), folder, scratch)
    archives = listing.collect()
    assert len(archives) == 2 and sum(row.records for row in archives) == pages.count()
    for row in archives:
        with open(row.archive, "rb") as source:
            magic, size = struct.unpack("<II", source.read(8))
            assert magic == DICTIONARY_MAGIC
            dictionary = zstandard.ZstdCompressionDict(source.read(size))
            record = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj().decompress(source.read())
        assert record.startswith(b"WARC/1.1\r\nWARC-Type: ")
    back = read_archives(listing, folder, payloads=True).where("record_type = 'response'")
    assert {(r.page_id, bytes(r.payload).decode()) for r in back.collect()} <= {
        (r.page_id, r.html) for r in pages.collect()}


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_mixing_cases(spark):
    rows = [(at, "some words here " * (at % 7 + 1), f"s{at % 3 and 1}", "en" if at // 3 % 4 else None, 1) for at in range(400)]
    rows += [(500, None, "s0", "en", 1), (501, "", None, None, 1),  (None, "text", None, "en", 1), (3, rows[3][1], "s0", "en", 1)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, probability int")
    out = mix(frame).toPandas()
    assert len(out) == len(rows) and out.probability.between(0, 1).all() and out[out.tokens == 0].kept.all()
    assert abs((out.probability * out.tokens).sum() / out.tokens.sum() - 0.5) < 1e-6
    assert abs(out[out.kept].tokens.sum() / out.tokens.sum() - 0.5) < 0.1
    kept = sampled(frame)
    assert kept.columns == frame.columns and kept.count() == out.kept.sum()
    long = spark.createDataFrame([(1, "long " * 50_000, "s0", "en", 1)], frame.schema)
    assert [(r.tokens, round(r.probability, 6)) for r in mix(long).collect()] == [(50_000, 0.5)]
    assert mix(frame.limit(0)).collect() == sampled(frame.limit(0)).collect() == []


def test_placement(spark):
    names = [f"shard-{at:05d}" for at in range(64)]
    table = fill_table(names)
    sizes = np.bincount(table)
    assert len(table) == 65_537 and sizes.max() - sizes.min() <= 1
    fewer = fill_table(names[:-1])
    assert np.mean([a != b for a, b in zip(table, fewer) if a != 63]) < 0.1
    weighed = np.bincount(fill_table(["a", "b"], 101, [3, 1]))
    assert abs(weighed[0] - 3 * weighed[1]) <= 4
    docs = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (None, "x"), (None, None)], "doc_id long, text string") \
        .selectExpr("*", "'old' AS shard")
    out = place_documents(docs).toPandas()
    assert len(out) == 5 and out[out.doc_id == 1].shard.nunique() == 1
    want = {r.doc_id: r.h % 65_537 for r in docs.selectExpr("doc_id", "xxhash64(CAST(doc_id AS STRING)) AS h").collect()}
    assert all(row.slot == want[row.doc_id] and row.shard == table[row.slot]
               for row in out.itertuples() if row.doc_id == row.doc_id)
    assert place_documents(docs.limit(0)).collect() == []


def test_language_of_rows_not_learned_from(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    edges = spark.createDataFrame(
        [(9000, None, "en"), (9001, "", None), (9002, "12 %% 34", "en"), (None, "the of and to", "en")],
        "doc_id long, text string, lang string").selectExpr("*", "'s' AS source", "1L AS n_chars")
    both = docs.unionByName(edges).selectExpr("*", "1 AS score", "2 AS held_out")
    model = fit(both)
    out = identify(both, model).join(docs.select("doc_id", "lang"), "doc_id", "left").toPandas()
    held = out[out.held_out & out.lang.notna()]
    assert (held.lang_pred == held.lang).mean() > 0.95
    assert set(out[out.doc_id.between(9000, 9002)].lang_pred) == {"und"} and out.score.between(0, 1).all()
    assert identified(both, model).columns == both.columns
    assert identified(docs, model).count() >= 0.99 * docs.count()
    nothing = docs.limit(0)
    assert identify(nothing, fit(nothing)).collect() == []
    assert {r.lang_pred for r in identify(docs.limit(3), {"families": []}).collect()} == {"und"}


def test_quality_of_rows_not_learned_from(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    out = quality_scores(docs, labels).join(labels, "doc_id").toPandas()
    held = out[out.held_out]
    assert len(held) > 50 and (held.predicted == held.quality).mean() > 0.9
    bias, rules = learn(featurized(docs), labels)
    assert 0 < len(rules) < 200
    values = featurized(docs).withColumn("__score", compiled(bias, rules)).toPandas()
    margin = bias + sum(weight * holds(values[list(shares())].to_numpy(), rule) for rule, weight in rules)
    assert np.allclose(1 / (1 + np.exp(-margin)), values["__score"])


def test_quality_cases(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "a b"), (3, "w " * 50_000)], "doc_id long, text string") \
        .selectExpr("*", "1 AS words", "2 AS quality")
    labels = spark.createDataFrame([(1, None), (2, 1)], "doc_id long, quality int")
    out = quality_scores(docs, labels).toPandas()
    assert len(out) == 4 and out.score.between(0, 1).all() and out.predicted.eq((out.score >= 0.7).astype(int)).all()
    assert set(quality_scores(docs, labels.limit(0)).toPandas().score) == {0.5}
    assert quality_scores(docs.limit(0), labels).collect() == []
