"""Importance resampling towards a target distribution, over hashed runs of words.

1. The distinct words of a stretch of text, each bounded by delimiters on both sides, are the dictionary of an
   Aho-Corasick automaton. A word's payload is its CRC and its length in bytes; scanning the text emits the payloads of
   its words in order.
2. The CRC of a run of words follows from the payloads of its neighbours alone: shift the left CRC by the length of what
   comes next, add the right one. The CRC modulo the number of buckets is the run's bucket.
3. Buckets are counted over all documents and all target texts; a bucket's gain is the logarithm of how much more often
   the target has it. A document weighs the mean gain of its runs.
4. Weights plus Gumbel noise from a hash of the document's id are ranked, and the highest are drawn without repetition.

Texts are scanned once: the buckets of a document's runs are stored, two bytes each before compression, for counting and
for weighing. Counting sends at most one row a bucket and task; the gains are one number a bucket, which bounds what is
broadcast. The ranking is a range sort whose partitions are numbered from their sizes, so no task sees more than its share.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window, functions as F

from .scratch import Scratch

BUCKETS = 10_000
RUNS = (1, 1)  # fewest and most words in a run
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024

DICTIONARY_BYTES = 1 << 20  # distinct words of one automaton
STRETCH_BYTES = 6 << 20  # text that one automaton scans
LONGEST_KEY = 256  # bytes; a longer word is scanned under a short name of its own

# Bytes that are part of words are digits, lower-case letters and all bytes of non-ASCII characters.
WORD_BYTES = frozenset([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])
CRC_POLYNOMIAL = 0xEDB88320


def shifted(crc, lengths):
    """CRCs of texts as they stand in the CRC of those texts followed by ``lengths`` more bytes (both uint64 arrays).

    A shift by one byte is linear in the bits of a CRC, so it is known by what it makes of each of the 32 bits; shifts by
    powers of two follow by applying it to itself.
    """
    import numpy as np

    def applied(images, values):
        out = np.zeros_like(values)
        for bit in range(32):
            out ^= images[bit] * ((values >> np.uint64(bit)) & np.uint64(1))
        return out

    images = np.empty(32, np.uint64)
    for bit in range(32):
        value = 1 << bit
        for _ in range(8):
            value = (value >> 1) ^ (CRC_POLYNOMIAL if value & 1 else 0)
        images[bit] = value
    crc, lengths = crc.copy(), lengths.copy()
    while lengths.any():
        odd = (lengths & np.uint64(1)).astype(bool)
        crc[odd] = applied(images, crc[odd])
        images = applied(images, images)
        lengths >>= np.uint64(1)
    return crc


def run_crcs(payloads, fewest: int, most: int):
    """CRCs of all runs of ``fewest`` to ``most`` neighbouring words, joined by one space, from the words' payloads."""
    import zlib

    import numpy as np

    crcs, lengths = payloads & np.uint64(0xFFFFFFFF), payloads >> np.uint64(32)
    space, one, found = np.uint64(zlib.crc32(b" ")), np.uint64(1), []
    so_far = crcs
    for words in range(1, min(most, len(crcs)) + 1):
        if words > 1:
            ends = slice(words - 1, None)
            so_far = shifted(so_far[:-1], np.full(len(so_far) - 1, one)) ^ space
            so_far = shifted(so_far, lengths[ends]) ^ crcs[ends]
        if words >= fewest:
            found.append(so_far)
    return np.concatenate(found) if found else np.empty(0, np.uint64)


def payload_scanner():
    """A function that takes an iterator of (key, text or None) and yields (key, payloads of its words in order)."""
    import zlib
    from operator import itemgetter

    import ahocorasick
    import numpy as np

    # A-Z becomes a-z and what is no part of a word a space, in one pass over the bytes.
    table = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in WORD_BYTES else 0x20 for b in range(256))

    def pieces(key, text):
        """(key, bytes, whether the text ends here), cut between words, so that a stretch stays bounded."""
        data = (text or "").encode("utf-8", "surrogatepass").translate(table)
        start = 0
        while len(data) - start > STRETCH_BYTES:
            end = data.find(b" ", start + STRETCH_BYTES)
            if end < 0:
                break
            yield key, data[start:end], False
            start = end
        yield key, data[start:] if start else data, True

    def scan(waiting, words):
        """Payloads of each waiting piece; ``words`` are all their distinct words."""
        automaton, names = ahocorasick.Automaton(), {}
        for at, word in enumerate(words):
            name = word
            if len(word) > LONGEST_KEY:
                names[word] = name = b"\x01%d" % at  # no word holds this character
            automaton.add_word(f" {name.decode('latin-1')} ", len(word) << 32 | zlib.crc32(word))
        if words:
            automaton.make_automaton()
        for key, data, last in waiting:
            if names:
                data = b" ".join(names.get(word, word) for word in data.split())
            found = map(itemgetter(1), automaton.iter(f" {data.decode('latin-1')} ")) if words else ()
            yield key, np.fromiter(found, np.uint64), last

    def stretches(texts):
        waiting, words, held, size = [], set(), 0, 0
        for key, text in texts:
            for piece in pieces(key, text):
                waiting.append(piece)
                size += len(piece[1])
                new = set(piece[1].split()) - words
                words |= new
                held += sum(map(len, new))
                if held > DICTIONARY_BYTES or size > STRETCH_BYTES:
                    yield from scan(waiting, words)
                    waiting, words, held, size = [], set(), 0, 0
        yield from scan(waiting, words)

    def payloads(texts) -> Iterator:
        parts = []
        for key, found, last in stretches(texts):
            parts.append(found)
            if last:
                yield key, parts[0] if len(parts) == 1 else np.concatenate(parts)
                parts = []

    return payloads


def hashed_runs(texts: DataFrame, buckets: int = BUCKETS, runs: tuple[int, int] = RUNS) -> DataFrame:
    """(doc_id, n_words, places) per row of ``texts`` (doc_id, text): the buckets of its runs, four bytes or two each."""
    width = _width(buckets)

    def hash_texts(batches):
        import numpy as np
        import pyarrow as pa

        scan = payload_scanner()
        for batch in batches:
            words, places = [], []
            for _, payloads in scan((None, text.as_py()) for text in batch.column("text")):
                words.append(len(payloads))
                places.append((run_crcs(payloads, *runs) % np.uint64(buckets)).astype(width).tobytes())
            yield pa.record_batch([batch.column("doc_id"), pa.array(words, pa.int64()), pa.array(places, pa.binary())],
                                  names=["doc_id", "n_words", "places"])

    return texts.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        hash_texts, "doc_id long, n_words long, places binary")


def _width(buckets: int) -> str:
    return "<u2" if buckets <= 1 << 16 else "<u4"


def bucket_counts(hashed: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) of all runs in ``places``; buckets without any are left out."""
    width = _width(buckets)

    def count(batches):
        import numpy as np
        import pyarrow as pa

        totals = np.zeros(buckets, np.int64)
        for batch in batches:
            for places in batch.column("places"):
                totals += np.bincount(np.frombuffer(places.as_buffer(), width), minlength=buckets)
        held = np.flatnonzero(totals)
        yield pa.record_batch([pa.array(held), pa.array(totals[held])], names=["bucket", "n"])

    return hashed.select("places").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, gain) for every bucket, from the counts (bucket, n) of source and target."""
    all_s, all_t = (counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] for counts in (source, target))
    counts = (
        source.sparkSession.range(buckets).select(F.col("id").alias("bucket"), F.lit(0).alias("s"), F.lit(0).alias("t"))
        .unionAll(source.select("bucket", "n", F.lit(0))).unionAll(target.select("bucket", F.lit(0), "n"))
        .groupBy("bucket").agg(F.sum("s").cast("double").alias("s"), F.sum("t").cast("double").alias("t")))
    ratio = (F.col("t") + 1) * float(all_s + buckets) / ((F.col("s") + 1) * float(all_t + buckets))
    return counts.select("bucket", F.floor(1000 * F.log(ratio)).alias("gain"))


def weighed(hashed: DataFrame, gains: list[int]) -> DataFrame:
    """(doc_id, n_words, n_features, weight) per row: the floored mean gain of a text's runs, 0 where it has none."""
    width = _width(len(gains))

    def weigh(batches):
        import numpy as np
        import pyarrow as pa

        table = np.array(gains, np.int64)
        for batch in batches:
            features, weights = [], []
            for places in batch.column("places"):
                places = np.frombuffer(places.as_buffer(), width)
                features.append(len(places))
                weights.append(int(table[places].sum()) // len(places) if len(places) else 0)
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("n_words"), pa.array(features, pa.int64()),
                 pa.array(weights, pa.int64())], names=["doc_id", "n_words", "n_features", "weight"])

    return hashed.mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long")


def gumbel(doc_id: Column, seed: int) -> Column:
    """Noise in thousandths, the same for a document on every run: -ln(-ln(u)) with u from a hash of its id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((drawn + 0.5) / 4294967296.0)))


def placed(rows: DataFrame, order: list[Column], scratch: Scratch) -> DataFrame:
    """``rows`` with ``place``, their number from 1 in ``order``, which must leave no ties.

    Rows are range-partitioned and sorted; a row's place is that in its partition plus the sizes of those before it.
    """
    numbered = scratch.keep(
        rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()),
        "ordered")
    part = F.shiftright("at", 33)
    sizes = numbered.groupBy(part.alias("part")).count()
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    starts = sizes.select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    return numbered.withColumn("part", part).join(F.broadcast(starts), "part").withColumn(
        "place", F.col("start") + F.col("at") - F.shiftleft("part", 33) + 1).drop("part", "at", "start")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS,
             buckets: int = BUCKETS, runs: tuple[int, int] = RUNS, seed: int = SEED,
             scratch: Scratch | None = None) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) for every row of ``docs`` (doc_id, text); ``target`` has a column text.

    ``rank`` is null but for the floor(percent * N / 100) highest scores of the N documents with ``least_words`` words.
    Defined cases: a null or empty text, or one without words, has no features and weight 0. Rows that repeat a doc_id
    share their noise and are ranked each; ties go to the smaller doc_id, rows without one last. Rows without doc_id share
    one noise. Text of any length is scanned whole. Other columns are ignored; an empty target or source counts nothing,
    and an empty ``docs`` gives no rows.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    hashed = scratch.keep(hashed_runs(docs, buckets, runs), "runs")
    wanted = hashed_runs(target.select(F.lit(None).alias("doc_id"), "text"), buckets, runs)
    gains = bucket_gains(*(scratch.keep(bucket_counts(texts, buckets), "counts") for texts in (hashed, wanted)), buckets)
    table = [row.gain for row in sorted(gains.collect())]  # one number a bucket
    scored = scratch.keep(
        weighed(hashed, table).withColumns({
            "score": F.col("weight") + gumbel(F.col("doc_id"), seed), "enough": F.col("n_words") >= least_words,
            "row_no": F.monotonically_increasing_id()}), "scored")
    scratch.drop(hashed)
    order = [F.desc("enough"), F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row_no")]
    ranked = placed(scored, order, scratch)
    draws = percent * scored.where("enough").count() // 100
    scratch.drop(scored)
    return ranked.select(
        "doc_id", "n_features", "weight", "score",
        F.when(F.col("enough") & (F.col("place") <= draws), F.col("place")).alias("rank"))


def resampled(docs: DataFrame, target: DataFrame, percent: int = PERCENT, scratch: Scratch | None = None,
              **options) -> DataFrame:
    """The drawn rows of ``docs`` with their own columns; rows without doc_id are never drawn here, and rows that repeat a
    doc_id are drawn together."""
    scratch = scratch or Scratch(docs.sparkSession)
    ids = scratch.keep(
        resample(docs, target, percent, scratch=scratch, **options).where("rank IS NOT NULL AND doc_id IS NOT NULL")
        .select("doc_id").distinct().withColumnRenamed("doc_id", "__drawn"), "drawn")
    return docs.join(ids, F.col("doc_id").cast("long") == F.col("__drawn"), "left_semi")
