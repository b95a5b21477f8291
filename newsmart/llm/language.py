"""Language identification by hierarchical discrimination.

Texts become hashed letter n-grams. A family classifier (one linear machine per family) chooses the language family;
inside it, one linear support vector machine per pair of languages votes. All machines are fitted on a bounded sample
of labelled rows; prediction reads whole texts in one pass and moves nothing between machines.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import combinations

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

SAMPLE_ROWS = 2000  # labelled rows the machines are fitted on, about; shared evenly by the languages
FEATURES = 4096
UNDETERMINED = "und"

# Language codes by family. A language not listed is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "fy", "lb"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "sl", "hr", "sr", "bs", "bg", "mk"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz"),
    "indic": ("hi", "bn", "mr", "ur", "pa", "gu", "ne"),
    "semitic": ("ar", "he", "mt", "am"),
}


def family_of(language: str) -> str:
    code = language.lower().replace("_", "-").split("-")[0]
    return next((family for family, members in FAMILIES.items() if code in members), language)


def make_featurizer(features: int = FEATURES):
    """A function text → vector of unit length (None without a letter), over one to three letters and word ends."""
    import numpy as np

    letter = np.zeros(0x110000, bool)
    letter[[point for point in range(0x110000) if chr(point).isalpha()]] = True
    factors = [np.uint32(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)]
    shift, chunk = np.uint32(32 - features.bit_length() + 1), 1 << 20

    def featurize(text):
        counts = np.zeros(features)
        lowered = (text or "").lower()
        for at in range(0, len(lowered), chunk):
            # Two characters of overlap, so that runs across a cut count once.
            points = np.frombuffer(lowered[max(0, at - 2):at + chunk].encode("utf-32-le", "surrogatepass"), np.uint32)
            is_letter = letter[points]
            codes = np.where(is_letter, points, np.uint32(32))
            if not at:
                codes = np.concatenate([np.full(2, 32, np.uint32), codes])
                is_letter = np.concatenate([np.zeros(2, bool), is_letter])
            last, middle, first = codes[2:], codes[1:-1], codes[:-2]
            here = is_letter[2:] | is_letter[1:-1]
            one = (last * factors[0])
            two = one + middle * factors[1]
            three = two + first * factors[2]
            for grams, keep in ((one + np.uint32(1), is_letter[2:]), (two + np.uint32(2), here),
                                (three + np.uint32(3), here)):
                grams = grams[keep]
                grams ^= grams >> np.uint32(15)
                counts += np.bincount((grams * factors[1]) >> shift, minlength=features)
        if not counts.any():
            return None
        values = np.sqrt(counts)
        return values / np.sqrt((values ** 2).sum())

    return featurize


def labelled_sample(docs: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """(lang, text): about ``rows`` of the rows for training, the languages in equal parts, chosen by a hash of doc_id.

    For training are rows with lang, text and doc_id whose crc32(doc_id as text) mod 4 is not 2.
    """
    usable = docs.where(
        "lang IS NOT NULL AND doc_id IS NOT NULL AND text IS NOT NULL"
        " AND pmod(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)), 4) <> 2").select("doc_id", "lang", "text")
    counts = usable.groupBy("lang").count().collect()  # one row per language
    share = rows / max(1, len(counts))
    chosen = F.create_map(*(F.lit(x) for row in counts for x in (row["lang"], min(1.0, share / row["count"])))) \
        if counts else F.create_map(F.lit(""), F.lit(0.0))
    drawn = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    return usable.where(drawn < F.try_element_at(chosen, F.col("lang"))).select("lang", "text")


def fit(docs: DataFrame, rows: int = SAMPLE_ROWS, features: int = FEATURES) -> dict:
    """The machines: {"families": [(family, weights, languages, {(one, other): weights})]}; empty without rows."""
    import numpy as np

    from .svm import train

    def vectors(batches):
        import pyarrow as pa

        featurize = make_featurizer(features)
        for batch in batches:
            made = [featurize(text.as_py()) for text in batch.column("text")]
            yield pa.record_batch(
                [batch.column("lang"),
                 pa.array([None if x is None else x.astype(np.float32).tobytes() for x in made], pa.binary())],
                names=["lang", "vector"])

    sample = labelled_sample(docs, rows).mapInArrow(vectors, "lang string, vector binary").where(
        "vector IS NOT NULL").toPandas().sort_values(["lang", "vector"])
    if sample.empty:
        return {"families": []}
    matrix = np.stack([np.frombuffer(x, np.float32) for x in sample["vector"]])
    labels = sample["lang"].to_numpy()
    del sample
    groups = defaultdict(list)
    for language in sorted(set(labels)):
        groups[family_of(language)].append(language)
    families = []
    for family, languages in sorted(groups.items()):
        own = np.isin(labels, languages)
        weights = train(matrix, own) if len(groups) > 1 else np.zeros(features + 1)
        pairs = {}
        for one, other in combinations(languages, 2):
            both = np.isin(labels, (one, other))
            pairs[one, other] = train(matrix[both], labels[both] == one)
        families.append((family, weights, languages, pairs))
    return {"families": families}


def language_column(text: Column, model: dict, features: int = FEATURES) -> Column:
    """struct(lang_pred, score) of whole texts by ``model``.

    ``score`` is the chance given to the family times the least chance given to the language in its duels, both by
    the logistic function of the machines' margins. A text without a letter, or any text when nothing could be
    learned, is "und" with score 0. Ties go to the first language by name.
    """
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        import numpy as np

        featurize = make_featurizer(features)
        families = model["families"]
        by_family = np.stack([weights for _, weights, _, _ in families]) if families else None

        def chance(margin):
            return 1 / (1 + np.exp(-4 * margin))

        def predicted(text):
            vector = featurize(text)
            if vector is None or by_family is None:
                return UNDETERMINED, 0.0
            parts = chance(by_family[:, :-1] @ vector + by_family[:, -1])
            best = int(np.argmax(parts))
            _, _, languages, pairs = families[best]
            votes, doubt = dict.fromkeys(languages, 0), dict.fromkeys(languages, 1.0)
            for (one, other), weights in pairs.items():
                part = chance(weights[:-1] @ vector + weights[-1])
                votes[one if part >= 0.5 else other] += 1
                doubt[one], doubt[other] = min(doubt[one], part), min(doubt[other], 1 - part)
            language = max(languages, key=lambda name: (votes[name], doubt[name]))
            return language, float(parts[best] / parts.sum() * doubt[language])

        for texts in batches:
            yield pd.DataFrame([predicted(text) for text in texts], columns=["lang_pred", "score"])

    return F.pandas_udf(predict, "lang_pred string, score double")(text)


def identify(docs: DataFrame, model: dict) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) per row of ``docs`` (doc_id, text).

    Defined cases: a null or empty text, or one without a letter, is "und" with score 0, as is every text when
    nothing could be learned; held_out is false without doc_id. Repeated rows are each predicted; other columns are
    ignored; an empty table gives no rows.
    """
    held_out = F.expr("coalesce(pmod(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)), 4) = 2, false)")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"),
        language_column(F.col("text"), model).alias("found"),
    ).select("doc_id", "held_out", "found.lang_pred", "found.score")


def identified(docs: DataFrame, model: dict, least_score: float = 0.2) -> DataFrame:
    """The rows of ``docs`` whose language is found with ``least_score``, with their own columns."""
    found = docs.withColumn("__found", language_column(F.col("text"), model))
    return found.where((F.col("__found.lang_pred") != UNDETERMINED) & (F.col("__found.score") >= least_score)).select(
        *docs.columns)
