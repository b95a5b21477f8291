"""The registered queries of this package, each over its whole table, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from .codes import ENTRIES, PARTS, ROUNDS, SCALE, vector_codes
from .importance import resample
from .language import fit, identify
from .licenses import scan_licenses
from .lines import without_like_lines
from .minhash import near_duplicates
from .mixing import ROUNDS as MIXING_ROUNDS, STEPS, mix
from .neighbours import nearest_neighbours
from .packing import pack_documents
from .placement import place_documents
from .quality import quality_scores
from .scratch import Scratch
from .vectors import near_vectors
from .warc import archive_pages


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pack_with_public_tokenizer(docs: DataFrame) -> DataFrame:
    return pack_documents(
        docs, Scratch(docs.sparkSession), public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_with_public_tokenizer(_table(spark, sf_dir, "documents"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(_table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(_table(spark, sf_dir, "embeddings"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_like_lines(_table(spark, sf_dir, "documents")).select("doc_id", "n_dropped", "text")


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = _table(spark, sf_dir, "embeddings")
    return nearest_neighbours(embeddings, embeddings.where(F.col("vec_id") % 20 == 0))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(_table(spark, sf_dir, "documents")).withColumn("probability", F.round("probability", 4))


def op7_placement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return place_documents(_table(spark, sf_dir, "documents")).select("doc_id", "slot", "shard")


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return identify(docs, fit(docs))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), words=2)


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(_table(spark, sf_dir, "embeddings"))


def op13_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(_table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_packing": op1_packing,
    "op2_warc": op2_warc,
    "op3_embedding_dedup": op3_embedding_dedup,
    "op4_line_dedup": op4_line_dedup,
    "op5_neighbours": op5_neighbours,
    "op6_mixing": op6_mixing,
    "op7_placement": op7_placement,
    "op8_language": op8_language,
    "op9_quality": op9_quality,
    "op10_minhash": op10_minhash,
    "op11_importance": op11_importance,
    "op12_vector_codes": op12_vector_codes,
    "op13_licenses": op13_licenses,
    "pipeline": pipeline,
}

def _mixing_sql(fraction: float = 0.5, rounds: int = MIXING_ROUNDS, steps: int = STEPS) -> str:
    """Raking of the cells; a round takes ``steps`` steps on each margin, one inside the other."""
    margins = ("source", "lang", "topic")
    wants = "".join(f"""
        held_{m} AS (SELECT {m}, sum(tokens) AS held FROM cells GROUP BY {m}),
        wish_{m} AS (SELECT {m}, held, {fraction} * (SELECT sum(tokens) FROM cells) * sqrt(held) / (SELECT sum(sqrt(held)) FROM held_{m}) AS wish
                     FROM held_{m}),
        scale_{m} AS (
            SELECT ({fraction} * (SELECT sum(tokens) FROM cells) - whole) / open AS scale FROM (
                SELECT held, wish, coalesce(sum(held) OVER before, 0) AS whole, sum(wish) OVER () - coalesce(sum(wish) OVER before, 0) AS open
                FROM wish_{m} WINDOW before AS (ORDER BY wish / held DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
            WHERE wish * ({fraction} * (SELECT sum(tokens) FROM cells) - whole) / open < held ORDER BY wish / held DESC LIMIT 1),
        want_{m} AS (SELECT {m}, least(wish * coalesce((SELECT scale FROM scale_{m}), held / wish), held) AS want_{m} FROM wish_{m}),"""
        for m in margins)
    step = "raked WHERE round < " + str(rounds)
    for m in (name for name in margins for _ in range(steps)):
        step = f"""(SELECT * EXCLUDE (whole, open, held) REPLACE (least(w * CASE
            WHEN want_{m} > whole AND open > 0 THEN (want_{m} - whole) / open WHEN want_{m} >= whole THEN 1.0
            ELSE want_{m} / held END, 1e250::DOUBLE) AS w)
          FROM (SELECT *, sum(CASE WHEN w >= tokens THEN tokens ELSE 0 END) OVER part AS whole,
                       sum(CASE WHEN w < tokens THEN w ELSE 0 END) OVER part AS open, sum(least(w, tokens)) OVER part AS held
                FROM {step} WINDOW part AS (PARTITION BY {m})))"""
    return rf"""
        WITH RECURSIVE docs AS (
            SELECT doc_id, coalesce(source, 'unknown') AS source, coalesce(lang, 'unknown') AS lang,
                   CASE WHEN length(text) - length(translate(text, '|', '')) > 0.02 * length(text) THEN 'table'
                        WHEN length(text) - length(translate(text, '0123456789', '')) > 0.05 * length(text) THEN 'figures'
                        WHEN length(text) - length(translate(text, '!*#$%&', '')) > 0.02 * length(text) THEN 'shouting'
                        ELSE 'prose' END AS topic,
                   coalesce(len(regexp_extract_all(text, '\S+')), 0) AS tokens
            FROM documents),
        cells AS (
            SELECT source, lang, topic, sum(tokens)::DOUBLE AS tokens FROM docs GROUP BY ALL HAVING sum(tokens) > 0),{wants}
        raked AS (
            SELECT 0 AS round, source, lang, topic, tokens, want_source, want_lang, want_topic, {fraction}::DOUBLE * tokens AS w
            FROM cells JOIN want_source USING (source) JOIN want_lang USING (lang) JOIN want_topic USING (topic)
            UNION ALL
            SELECT round + 1, source, lang, topic, tokens, want_source, want_lang, want_topic, w FROM {step}),
        plan AS (SELECT source, lang, topic, least(w / tokens, 1.0) AS probability FROM raked WHERE round = {rounds}),
        joined AS (
            SELECT docs.*, CASE WHEN docs.tokens = 0 THEN 1.0 ELSE coalesce(probability, 0.0) END AS p,
                   ('0x' || substr(md5(doc_id::VARCHAR || ':1'), 1, 13))::BIGINT / 4503599627370496.0 AS u
            FROM docs LEFT JOIN plan USING (source, lang, topic))
        SELECT doc_id, source, lang, topic, tokens, round(p, 4) AS probability, u < p AS kept FROM joined
    """


def _codes_sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """Integer k-means, one set of tables a round."""
    apart = "list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    steps = []
    for turn in range(rounds + 1):
        steps.append(f"""
        near{turn} AS MATERIALIZED (
            SELECT row_no, p, any_value(x) AS x, arg_min(e, (d, e)) AS e, min(d) AS d
            FROM (SELECT row_no, p, x, e, {apart} AS d FROM parts JOIN book{turn} USING (p)) GROUP BY row_no, p)""")
        if turn < rounds:
            steps.append(f"""
        book{turn + 1} AS MATERIALIZED (
            SELECT p, e, coalesce(m, c) AS c FROM book{turn} LEFT JOIN (
                SELECT p, e, list(mean ORDER BY i) AS m FROM (
                    SELECT p, e, i, floor(sum(x[i])::DOUBLE / count(*))::BIGINT AS mean
                    FROM near{turn}, unnest(range(1, len(x) + 1)) AS u(i) GROUP BY p, e, i) GROUP BY p, e) USING (p, e))""")
    return f"""
        WITH kept AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY vec_id) AS row_no, vec_id, label,
                   list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        parts AS MATERIALIZED (
            SELECT row_no, p, v[p * len(v) // {parts} + 1:(p + 1) * len(v) // {parts}] AS x
            FROM kept, unnest(range({parts})) AS u(p)),
        book0 AS (SELECT p, row_no - 1 AS e, x AS c FROM parts WHERE row_no <= {entries}),{",".join(steps)},
        coded AS (
            SELECT row_no, string_agg(lower(printf('%02x', e)), '' ORDER BY p) AS code, sum(d)::BIGINT AS error
            FROM near{rounds} GROUP BY row_no),
        digest AS (
            SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{rounds})
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
        FROM kept JOIN coded USING (row_no), digest
    """


SQL: dict[str, str] = {
    "op2_warc": """
        WITH payloads AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                   sha256(coalesce(html, '')) AS payload_digest
            FROM pages),
        firsts AS (
            SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest)
                           ELSE page_id END AS first
            FROM payloads)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first THEN first END AS refers_to
        FROM firsts
    """,
    "op3_embedding_dedup": """
        WITH RECURSIVE vectors AS (
            SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        links AS (
            SELECT x.vec_id AS a, y.vec_id AS b FROM vectors x JOIN vectors y ON x.vec_id <> y.vec_id
            WHERE list_dot_product(x.e, y.e) >= 0.95 * sqrt(list_dot_product(x.e, x.e) * list_dot_product(y.e, y.e))),
        reach AS (
            SELECT vec_id AS node, vec_id AS seen FROM embeddings
            UNION SELECT reach.node, links.b FROM reach JOIN links ON links.a = reach.seen),
        counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
        SELECT vec_id, coalesce(n, 0) AS n_links, c AS component_id, vec_id = c AS kept
        FROM embeddings LEFT JOIN counts ON a = vec_id
        JOIN (SELECT node, min(seen) AS c FROM reach GROUP BY node) ON node = vec_id
    """,
    "op6_mixing": _mixing_sql(),
    "op10_minhash": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, list_filter(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
            FROM documents),
        shingles AS (
            SELECT DISTINCT doc_id, unnest(CASE
                WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
                ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s
            FROM words),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        shared AS (
            SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
            FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
        links AS (
            SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
            WHERE 100 * shared.n >= 80 * (p.n + q.n - shared.n)),
        reach AS (
            SELECT doc_id AS node, doc_id AS seen FROM documents
            UNION SELECT reach.node, links.b FROM reach JOIN links ON links.a = reach.seen)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, c AS component_id, doc_id = c AS kept
        FROM documents LEFT JOIN sizes USING (doc_id)
        JOIN (SELECT node, min(seen) AS c FROM reach GROUP BY node) ON node = doc_id
    """,
    "op11_importance": r"""
        WITH crc_table AS MATERIALIZED (
            SELECT list(c ORDER BY i) AS crcs FROM (
                SELECT i, list_reduce([i] || list_transform(range(8), lambda k: 0::BIGINT),
                    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
                FROM (SELECT unnest(range(256)) AS i))),
        texts AS (
            SELECT 'd' AS kind, doc_id, text FROM documents UNION ALL SELECT 'b', NULL, text FROM benchmark),
        words AS MATERIALIZED (
            SELECT kind, doc_id, unnest(list_filter(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')) AS word
            FROM texts),
        vocabulary AS (SELECT word, hex(encode(word)) AS h FROM (SELECT DISTINCT word FROM words)),
        places AS MATERIALIZED (
            SELECT word, xor(list_reduce([4294967295] || list_transform(range(length(h) // 2),
                       lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT),
                       lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
            FROM vocabulary, crc_table),
        counts AS (
            SELECT bucket, count(*) FILTER (kind = 'd') AS s, count(*) FILTER (kind = 'b') AS t
            FROM words JOIN places USING (word) GROUP BY bucket),
        gains AS (
            SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * ((SELECT sum(s) FROM counts) + 10000)::DOUBLE
                / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM counts) + 10000)::DOUBLE)))::BIGINT AS gain
            FROM counts),
        sums AS (
            SELECT doc_id, count(*) AS n, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
            FROM words JOIN places USING (word) JOIN gains USING (bucket) WHERE kind = 'd' GROUP BY doc_id),
        scored AS (
            SELECT documents.doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
                   coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || documents.doc_id), 1, 8))
                       ::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
            FROM documents LEFT JOIN sums USING (doc_id)),
        ranked AS (
            SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS many
            FROM scored WHERE n_features >= 20)
        SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * many // 100 THEN place END AS rank
        FROM scored LEFT JOIN ranked USING (doc_id)
    """,
    "op12_vector_codes": _codes_sql(),
    "op13_licenses": r"""
        WITH templates(template, label, text, keys, base) AS (VALUES
            (0, 'mit', 'under the mit license', 'mit', true),
            (1, 'apache-2', 'apache license version 2', 'apache 2', true),
            (2, 'cc-by-nc', 'cc by nc', 'cc by nc', true),
            (3, 'mit', 'permission is hereby granted free of charge to any person', 'permission granted', false),
            (4, 'apache-2', 'licensed under the apache license version 2 0', 'apache 2', false),
            (5, 'cc-by-nc', 'creative commons attribution noncommercial', 'attribution noncommercial', false),
            (6, 'cc-by-nc', 'creative commons attribution non commercial', 'attribution non commercial', false),
            (7, 'gpl-3', 'gnu general public license version 3', 'gnu 3', false),
            (8, 'gpl-2', 'gnu general public license version 2', 'gnu 2', false),
            (9, 'lgpl', 'gnu lesser general public license', 'lesser', false),
            (10, 'agpl', 'gnu affero general public license', 'affero', false),
            (11, 'mpl', 'mozilla public license', 'mozilla', false),
            (12, 'bsd', 'under the bsd license', 'bsd', false),
            (13, 'bsd', 'redistribution and use in source and binary forms', 'redistribution binary', false)),
        listed AS (
            SELECT template, label, text, string_split(text, ' ') AS t, string_split(keys, ' ') AS keys, base,
                   len(string_split(text, ' ')) AS size, greatest(1, len(string_split(text, ' ')) // 5) AS gap
            FROM templates),
        docs AS MATERIALIZED (
            SELECT doc_id, list_filter(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
            FROM documents),
        grams AS (SELECT doc_id, p, w[p + 1] AS a, w[p + 2] AS b FROM docs, unnest(range(len(w) - 1)) AS u(p)),
        diagonals AS (
            SELECT doc_id, template, p - j AS d, count(*) AS votes
            FROM grams JOIN (SELECT template, j, t[j + 1] AS a, t[j + 2] AS b FROM listed, unnest(range(size - 1)) AS v(j))
            USING (a, b) GROUP BY ALL),
        placed AS MATERIALIZED (
            SELECT diagonals.*, w, t, text, label, keys, base, size, gap,
                   greatest(d - 2 * gap, 0) AS lo, least(d + size + 2 * gap, len(w)) AS hi
            FROM diagonals JOIN listed USING (template) JOIN docs USING (doc_id)
            WHERE list_has_all(w[greatest(d - 2 * gap, 0) + 1:least(d + size + 2 * gap, len(w))], keys)),
        exact AS (SELECT doc_id, label, d AS start FROM placed WHERE base AND d >= 0 AND w[d + 1:d + size] = t),
        grouped AS (
            SELECT doc_id, template, place, any_value(label) AS label, any_value(text) AS text, any_value(size) AS size, any_value(gap) AS gap,
                   any_value(keys) AS keys, any_value(w) AS w, min(d) AS low, max(d) AS high,
                   arg_max({'lo': lo, 'hi': hi}, (votes, -d)) AS best
            FROM (SELECT *, sum(fresh) OVER (PARTITION BY doc_id, template ORDER BY d) AS place
                  FROM (SELECT *, CASE WHEN d - lag(d) OVER (PARTITION BY doc_id, template ORDER BY d) <= gap
                                       THEN 0 ELSE 1 END AS fresh FROM placed))
            GROUP BY doc_id, template, place),
        spans AS (
            SELECT doc_id, label, text, keys, w[s + 1:e] AS words
            FROM grouped, unnest(range(greatest(low - gap, best.lo), least(high + gap, best.hi - 1) + 1)) AS x(s),
                 unnest(range(greatest(low + size - gap, best.lo + 1), least(high + size + gap, best.hi) + 1)) AS y(e)
            WHERE s < e),
        rated AS (
            SELECT doc_id, label,
                   (greatest(length(array_to_string(words, ' ')), length(text)) - levenshtein(array_to_string(words, ' '), text))
                   / greatest(length(array_to_string(words, ' ')), length(text)) AS similarity
            FROM spans WHERE list_has_all(words, keys)),
        told AS (
            SELECT doc_id, start, label AS base_label, label, 1.0::DOUBLE AS score FROM exact
            UNION ALL SELECT doc_id, NULL, NULL, label, similarity FROM rated WHERE similarity >= 0.8)
        SELECT docs.doc_id, len(any_value(w))::BIGINT AS n_words, count(start) AS n_base, min(start)::BIGINT AS first_word,
               max(start)::BIGINT AS last_word, coalesce(string_agg(DISTINCT base_label, ',' ORDER BY base_label), '') AS base_labels,
               coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels, coalesce(max(score), 0.0)::DOUBLE AS score
        FROM docs LEFT JOIN told USING (doc_id) GROUP BY docs.doc_id
    """,
}
