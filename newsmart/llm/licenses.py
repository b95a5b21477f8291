"""License notices in texts, by diagonal voting, in DataFrame functions alone.

1. Every run of ``K`` neighbouring words of a text is hashed and joined with the hashes of the templates' runs. The
   templates are a short fixed list, which bounds what is broadcast; words of the texts are not moved.
2. A hit votes for the diagonal its offset in the text minus its offset in the template names. Hits whose surroundings
   lack a template's key words are left out where they arise, as no span with them can be confirmed.
3. Diagonals of a text and template that are close to each other are merged: a word put in or left out moves the rest of
   a notice to the next diagonal.
4. The spans a merged diagonal stands for are verified by edit similarity with the template, and must hold its key
   words, the ones that tell one license from another. A diagonal with all votes is a place where the template's words
   stand consecutively, once its words have been compared.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .scratch import Scratch

K = 2
SIMILARITY = 0.8

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # what ends a word before A-Z are lower-cased


@dataclass(frozen=True)
class Template:
    """A notice's words, the label it stands for, the words a like span must hold, and whether its exact places count."""

    label: str
    text: str
    keys: tuple[str, ...]
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def gap(self) -> int:
        """How far apart diagonals of one place may lie."""
        return max(1, len(self.words) // 5)


# Notices by which licenses are told.
TEMPLATES: tuple[Template, ...] = (
    Template("mit", "under the mit license", ("mit",), base=True),
    Template("apache-2", "apache license version 2", ("apache", "2"), base=True),
    Template("cc-by-nc", "cc by nc", ("cc", "by", "nc"), base=True),
    Template("mit", "permission is hereby granted free of charge to any person", ("permission", "granted")),
    Template("apache-2", "licensed under the apache license version 2 0", ("apache", "2")),
    Template("cc-by-nc", "creative commons attribution noncommercial", ("attribution", "noncommercial")),
    Template("cc-by-nc", "creative commons attribution non commercial", ("attribution", "non", "commercial")),
    Template("gpl-3", "gnu general public license version 3", ("gnu", "3")),
    Template("gpl-2", "gnu general public license version 2", ("gnu", "2")),
    Template("lgpl", "gnu lesser general public license", ("lesser",)),
    Template("agpl", "gnu affero general public license", ("affero",)),
    Template("mpl", "mozilla public license", ("mozilla",)),
    Template("bsd", "under the bsd license", ("bsd",)),
    Template("bsd", "redistribution and use in source and binary forms", ("redistribution", "binary")),
)


def words_of(text: Column) -> Column:
    """The words of a whole text in its own case; none where it is null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), _BETWEEN), "")


def _gram(words: str, at: Column, k: int) -> Column:
    return F.xxhash64(*(F.lower(F.get(F.col(words), at + step)) for step in range(k)))


def template_grams(spark: SparkSession, templates: tuple[Template, ...], k: int) -> DataFrame:
    """(gram, template, t_at, t_words, t_keys, t_gap): the runs of ``k`` words of each template, by its number."""
    if any(len(template.words) < k for template in templates):
        raise ValueError(f"a template needs at least {k} words")
    rows = [(at, x.words, list(x.keys), x.gap) for at, x in enumerate(templates)]
    listed = spark.createDataFrame(rows, "template int, t_words array<string>, t_keys array<string>, t_gap int")
    placed = listed.select("*", F.explode(F.sequence(F.lit(0), F.size("t_words") - k)).alias("t_at"))
    return placed.select(_gram("t_words", F.col("t_at"), k).alias("gram"), *placed.columns)


def hits(docs: DataFrame, templates: tuple[Template, ...], k: int) -> DataFrame:
    """(row_no, doc_id, n_words, template, diagonal, left, context): one row at least for every row of ``docs``, whose
    template is null where there is no hit. ``context`` holds the words around the diagonal from place ``left`` on."""
    grams = template_grams(docs.sparkSession, templates, k)
    # A one-row explode keeps the optimizer from splitting a text again in each use of its words.
    texts = docs.select(
        F.monotonically_increasing_id().alias("row_no"), F.col("doc_id").cast("long").alias("doc_id"),
        F.explode(F.array(words_of(F.col("text")))).alias("words"))
    runs = texts.select("*", F.posexplode_outer("words").alias("at", "word")).withColumns({
        "n_words": F.size("words").cast("long"),
        "own_gram": F.when(F.col("at") + k <= F.size("words"), _gram("words", F.col("at"), k))})
    met = runs.join(F.broadcast(grams), F.col("own_gram") == F.col("gram"), "left")
    diagonal = F.col("at") - F.col("t_at")
    left = F.greatest(diagonal - 2 * F.col("t_gap"), F.lit(0))
    right = F.least(diagonal + F.size("t_words") + 2 * F.col("t_gap"), F.size("words"))
    first = F.coalesce(F.col("at"), F.lit(0)) == 0
    # What follows holds some words around a hit, never a whole text; it is cut where texts are still read one by one.
    cut = met.where(F.col("template").isNotNull() | first).select(
        "row_no", "doc_id", "n_words", "template", diagonal.alias("diagonal"), left.alias("left"),
        F.slice("words", left + 1, right - left).alias("around"), "t_keys", first.alias("first"))
    lowered = cut.select("*", F.explode(F.array(F.transform("around", lambda word: F.translate(word, UPPER, LOWER))))
                         .alias("context"))
    # A hit without the key words is none, but a text's first row stays, without it.
    keyed = F.coalesce(F.size(F.array_except("t_keys", "context")) == 0, F.lit(False))
    own = ("template", "diagonal", "left", "context")
    return lowered.where(keyed | F.col("first")).select(
        "row_no", "doc_id", "n_words", *(F.when(keyed, F.col(name)).alias(name) for name in own))


def _with_templates(rows: DataFrame, templates: tuple[Template, ...]) -> DataFrame:
    """Rows with the properties of their template as literals of one expression; the list is short."""
    def of(value) -> Column:
        return F.element_at(F.array(*(F.lit(value(template)) for template in templates)), F.col("template") + 1)

    return rows.withColumns({
        "label": of(lambda x: x.label), "t_text": of(lambda x: " ".join(x.words)), "t_size": of(lambda x: len(x.words)),
        "t_gap": of(lambda x: x.gap), "t_keys": F.split(of(lambda x: " ".join(x.keys)), " "), "t_base": of(lambda x: x.base)})


def voted(found: DataFrame, templates: tuple[Template, ...]) -> DataFrame:
    """(row_no, template, diagonal, votes, left, context, label, t_…): one row a diagonal with a vote."""
    votes = found.where("template IS NOT NULL").groupBy("row_no", "template", "diagonal").agg(
        F.count("*").alias("votes"), F.min("left").alias("left"), F.min("context").alias("context"))
    return _with_templates(votes, templates)


def exact_places(diagonals: DataFrame, k: int) -> DataFrame:
    """(row_no, label, start) of base templates' consecutive words, one row a place."""
    here = F.array_join(F.slice("context", F.col("diagonal") - F.col("left") + 1, F.col("t_size")), " ")
    return diagonals.where(
        F.col("t_base") & (F.col("votes") == F.col("t_size") - k + 1) & (F.col("diagonal") >= 0)
    ).where(here == F.col("t_text")).select("row_no", "label", F.col("diagonal").alias("start"))


def like_spans(diagonals: DataFrame, similarity: float) -> DataFrame:
    """(row_no, label, start, end, similarity) of the best span of each group of neighbouring diagonals that is like its
    template."""
    in_order = Window.partitionBy("row_no", "template").orderBy("diagonal")
    fresh = F.when(F.col("diagonal") - F.lag("diagonal").over(in_order) <= F.col("t_gap"), 0).otherwise(1)
    groups = diagonals.withColumn("fresh", fresh).withColumn("place", F.sum("fresh").over(in_order)).groupBy(
        "row_no", "template", "place", "label", "t_text", "t_size", "t_gap", "t_keys").agg(
        F.min("diagonal").alias("low"), F.max("diagonal").alias("high"),
        F.max(F.struct("votes", -F.col("diagonal"), "left", "context")).alias("best"))
    groups = groups.select("*", "best.left", "best.context")

    # Spans that begin and end within a gap of where the diagonals put the template's first and last word.
    stop = F.col("left") + F.size("context")
    starts = F.sequence(F.greatest(F.col("low") - F.col("t_gap"), F.col("left")),
                        F.greatest(F.least(F.col("high") + F.col("t_gap"), stop - 1), F.col("left")))
    ends = F.sequence(F.least(F.greatest(F.col("low") + F.col("t_size") - F.col("t_gap"), F.col("left") + 1), stop),
                      F.least(F.col("high") + F.col("t_size") + F.col("t_gap"), stop))

    def rated(start: Column, end: Column) -> Column:
        words = F.slice("context", start - F.col("left") + 1, F.greatest(end - start, F.lit(0)))
        text = F.array_join(words, " ")
        longest = F.greatest(F.length(text), F.length("t_text"))
        alike = F.when(F.size(F.array_except("t_keys", words)) == 0,
                       (longest - F.levenshtein(text, F.col("t_text"))) / longest).otherwise(0.0)
        return F.struct(alike.alias("similarity"), (-start).alias("minus_start"), end.alias("end"))

    spans = F.flatten(F.transform(starts, lambda start: F.transform(ends, lambda end: rated(start, end))))
    return groups.select("row_no", "label", F.explode(F.array(F.array_max(spans))).alias("s")).where(
        F.col("s.similarity") >= similarity).select(
        "row_no", "label", (-F.col("s.minus_start")).alias("start"), "s.end", "s.similarity")


def license_spans(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, k: int = K, similarity: float = SIMILARITY,
                  scratch: Scratch | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows of ``docs`` (row_no, doc_id, n_words), their exact places (row_no, label, start) and their like spans
    (row_no, label, start, end, similarity); places count words from 0, and ``end`` is the first word after a span."""
    scratch = scratch or Scratch(docs.sparkSession)
    found = scratch.keep(hits(docs, templates, k), "hits")
    diagonals = scratch.keep(voted(found, templates), "diagonals")
    rows = found.groupBy("row_no").agg(F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"))
    return rows, exact_places(diagonals, k), like_spans(diagonals, similarity)


def scan_licenses(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, k: int = K, similarity: float = SIMILARITY,
                  scratch: Scratch | None = None) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) for every row of ``docs`` (doc_id, text).

    ``n_base`` counts the exact places of base templates, which begin between ``first_word`` and ``last_word``; ``labels``
    has those of like spans too, and ``score`` is the greatest similarity of any, 0 without one.
    Defined cases: a null or empty text, or one without words, has no words, places or labels ("" each); first_word and
    last_word are null without a place. Repeated rows, and rows that repeat a doc_id or have none, are each scanned. Texts
    of any length are scanned whole. Overlapping places all count. Other columns are ignored; an empty table gives no rows.
    """
    rows, places, spans = license_spans(docs, templates, k, similarity, scratch)
    none = {"doc_id": "long", "n_words": "long", "start": "int", "base_label": "string", "label": "string", "score": "double"}

    def facts(frame: DataFrame, **columns: Column) -> DataFrame:
        return frame.select("row_no", *(
            columns.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in none.items()))

    told = reduce(DataFrame.unionAll, (
        facts(rows, doc_id=F.col("doc_id"), n_words=F.col("n_words")),
        facts(places, start=F.col("start"), base_label=F.col("label"), label=F.col("label"), score=F.lit(1.0)),
        facts(spans, label=F.col("label"), score=F.col("similarity"))))
    listed = {name: F.array_join(F.sort_array(F.collect_set(name)), ",") for name in ("base_label", "label")}
    return told.groupBy("row_no").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), F.count("start").alias("n_base"),
        F.min("start").cast("long").alias("first_word"), F.max("start").cast("long").alias("last_word"),
        listed["base_label"].alias("base_labels"), listed["label"].alias("labels"),
        F.coalesce(F.max("score"), F.lit(0.0)).alias("score")).drop("row_no")
