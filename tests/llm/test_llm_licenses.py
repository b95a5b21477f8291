"""License scans against a plain search of every place, and notices with small changes."""

import random
import re

import pytest

from newsmart.llm.licenses import TEMPLATES, Template, license_spans, scan_licenses
from test_llm_texts import edit_distance

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return WORD.findall((text or "").translate(LOWER))


def base_places(words):
    return sorted((at, x.label) for x in TEMPLATES if x.base for at in range(len(words))
                  if words[at:at + len(x.words)] == x.words)


def any_like(words):
    """Labels of all spans, however found, that are like a template and hold its key words."""
    found = set()
    for x in TEMPLATES:
        for start in range(len(words)):
            for size in range(len(x.words) - 2 * x.gap, len(x.words) + 4 * x.gap + 1):
                span = words[start:start + size]
                text = " ".join(span)
                if set(x.keys) <= set(span) and edit_distance(text, x.text) <= 0.2 * max(len(text), len(x.text)) + 1e-9:
                    found.add(x.label)
    return found


def noise(draws, size):
    vocabulary = ["under", "the", "license", "version", "by", "2", "cc", "nc", "house", "é", "中文", "tree", "a", "public"]
    return " ".join(draws.choices(vocabulary, k=size))


def test_scan_equals_a_plain_search(spark):
    draws = random.Random(5)
    notices = [x.text for x in TEMPLATES] + ["Released UNDER the MIT-License.", "CC BY-NC 4.0", "cc by nc cc by nc",
                                             "Apache License,\nVersion 2.0", "under the mit license version 2"]
    rows = [(at, " ".join(draws.choice([noise(draws, draws.randrange(0, 9)), draws.choice(notices)])
                          for _ in range(draws.randrange(0, 6)))) for at in range(80)]
    rows += [(900, None), (901, ""), (902, "-- ..."), (903, "word " * 50_000 + "under the MIT License"), (None, "cc by nc"),
             (904, "cc by nc"), (904, "cc by nc"), (905, "Kcc by nc under the mİt license")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "1 AS row_no", "2 AS template", "'x' AS label", "3 AS score", "4 AS words").repartition(3)
    out = sorted((tuple(r) for r in scan_licenses(frame).collect()), key=lambda r: (r[0] is None, r))
    assert len(out) == len(rows)
    for (doc_id, text), row in zip(sorted(rows, key=lambda r: (r[0] is None, r)), out):
        words = words_of(text)
        places = base_places(words)
        starts = [at for at, _ in places]
        base = ",".join(sorted({label for _, label in places}))
        assert row[:6] == (doc_id, len(words), len(places), min(starts, default=None), max(starts, default=None), base)
        labels = set(filter(None, row[6].split(",")))
        assert {label for _, label in places} <= labels
        if len(words) < 1000:
            assert labels <= any_like(words)
        assert 0 <= row[7] <= 1 and (row[7] >= 0.8) == bool(labels) and (not places or row[7] == 1)
    assert scan_licenses(frame.limit(0)).collect() == []


@pytest.mark.parametrize("text, labels, spans", [
    ("it is free under the mit licence today", "mit", [(3, 7)]),  # a letter
    ("licensed under mit license", "mit", [(1, 4)]),  # a word left out
    ("permission is hereby granted entirely free of charge to any person", "mit", [(0, 11)]),  # a word put in
    ("permission is hereby granted free of charge to any body", "mit", [(0, 10)]),
    ("under the bit license", "", []),  # its key word is another
    ("apache license version 1", "", []),
    ("GNU General Public License, version 3", "gpl-3", [(0, 6)]),
    ("the version of the license that any person reads under the tree", "", []),
    ("redistribution and use in source or binary form", "bsd", [(0, 8)]),
])
def test_changed_notices(spark, text, labels, spans):
    frame = spark.createDataFrame([(1, text)], "doc_id long, text string")
    (row,) = scan_licenses(frame).collect()
    assert (row.labels, row.n_base) == (labels, 0)
    found = license_spans(frame)[2].collect()
    assert sorted({(r.start, r.end) for r in found}) == spans


def test_own_templates(spark):
    frame = spark.createDataFrame([(1, "use as you like it"), (2, "as you like")], "doc_id long, text string")
    own = (Template("free", "as you like it", ("like", "it"), base=True),)
    assert {(r.doc_id, r.n_base, r.labels) for r in scan_licenses(frame, own, k=3).collect()} == {(1, 1, "free"), (2, 0, "")}
    with pytest.raises(ValueError):
        scan_licenses(frame, own, k=5)
