import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from newsmart import functions as fn
from newsmart.operators import explode_pairs


def _values(spark, texts, column):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    return [r.out for r in rows.select("i", column.alias("out")).orderBy("i").collect()]


WHOLE = ["", "abc", "7", "+7", "-7", " 7", "7 ", "1.5", "7\n", "1e3", "--1", "2147483647", "2147483648",
         "9223372036854775808", "0x1"]


def test_whole_numbers(spark):
    assert _values(spark, WHOLE, fn.int_or_zero("text")) == [0, 0, 7, 7, -7, 0, 0, 0, 0, 0, 0, 2147483647, 0, 0, 0]
    longs = _values(spark, WHOLE, fn.long_or_zero("text"))
    assert longs[-4:] == [2147483647, 2147483648, 0, 0]
    big = _values(spark, WHOLE + ["1" * 38, "1" * 39], fn.bigint_or_zero("text"))
    assert [int(v) for v in big[-4:]] == [9223372036854775808, 0, int("1" * 38), 0]


def test_doubles(spark):
    texts = ["", "abc", "1.5", " 1.5 ", "-2", "1e3", "1.5d", "inf", "nan", "Inf", "INFINITY", "-Infinity", "1,5"]
    assert _values(spark, texts, fn.double_or_zero("text")) == [
        0, 0, 1.5, 1.5, -2, 1000, 1.5, 0, 0, 0, 0, -math.inf, 0]
    assert math.isnan(_values(spark, ["NaN"], fn.double_or_zero("text"))[0])


def test_first_tone(spark):
    texts = ["1.5,2,3", "-3", "x,1", "", ",1", "inf,2"]
    assert _values(spark, texts, fn.first_tone("text", "float")) == [1.5, -3, None, None, None, None]


def test_source_language(spark):
    texts = ["srclc:fra;eng:Moses 2.1.1", "", "abc", ";", "srclc:r:f;x", ":", "srclc:;eng:x"]
    assert _values(spark, texts, fn.source_language(F.col("text"))) == ["fra", "", "abc", "", "r:f", "", ""]


def test_items(spark):
    assert _values(spark, ["A;B;", "", "A", "A;;B"], fn.items(F.col("text"))) == [
        ["A", "B", ""], [""], ["A"], ["A", "", "B"]]


def test_file_name(spark):
    assert _values(spark, ["http://feed.example/v2/20190101000000.export.CSV.zip", "x"], fn.file_name(F.col("text"))) \
        == ["20190101000000.export.CSV.zip", "x"]


def test_date_parts(spark):
    parts = fn.date_parts(F.col("text"))
    assert [_values(spark, ["20190115"], parts[p])[0] for p in ("year", "month", "day")] == ["2019", "01", "15"]
    labels = fn.item_date_parts(F.col("text"))
    assert [_values(spark, ["20190115093000"], labels[p])[0] for p in ("date", "year", "month", "day")] == [
        "20190115", "2019", "0115", "15"]
    calendar = fn.item_date_parts(F.col("text"), calendar_months=True)
    assert _values(spark, ["20190115093000"], calendar["month"]) == ["01"]
    days = _values(spark, ["20190115", "20191315", "0"], fn.feed_day(F.col("text")))
    assert str(days[0]) == "2019-01-15" and days[1:] == [None, None]


@pytest.mark.parametrize("args, period", [
    (("2019", "01", "15"), "20190115"), (("2019", "01"), "201901"), (("2019", "01", "15", "-"), "2019-01-15"),
    (("2019", "01", "", "-"), "2019-01")])
def test_reference_period(args, period):
    assert fn.reference_period(*args) == period


LOCATIONS = {
    "": [],
    "1#France#FR#FR##46#2#FR": ["France"],
    "1# #US#x": [""],
    "4##": [],
    "##": [],
    "##x": [""],
    "Lyon#a#b": ["Lyon"],
    "4#Kyoto, Kyoto, Japan#JA#JA22#35#135#-1;1#Chad#CD#x;2#Nara, Japan#JA#y": ["Japan", "Chad"],
    ", Peru#PE#PE1#1#2#3;\n   3#Lima, Peru#PE#x": ["Peru"],
    "1#Oman\n#MU#x": [],
    "\u0663#Fiji#FJ#x": ["Fiji"],
    " 12 # Mali #ML#x": ["Mali"],
}


def test_mentioned_countries(spark):
    assert _values(spark, list(LOCATIONS), fn.mentioned_countries(F.col("text"))) == list(LOCATIONS.values())


def _brute_countries(text):
    """The reading rule, piece by piece."""
    found, piece, pieces = [], "", []
    for char in text + ";":
        if char in ",;":
            pieces.append(piece)
            piece = ""
        else:
            piece += char
    blanks = "".join(map(chr, range(33)))
    for piece in pieces:
        if piece.count("#") < 2 or "\n" in piece or "\u2028" in piece:
            continue
        parts = piece.split("#")
        while parts and parts[-1] == "":
            parts.pop()
        if not parts:
            continue
        name = parts[0].strip(blanks)
        if all(char.isdecimal() for char in name):
            if len(parts) < 2:
                continue
            name = parts[1].strip(blanks)
        if name not in found:
            found.append(name)
    return found


def test_countries_and_pairs_match_brute_force(spark):
    draw = random.Random(7)
    texts = ["".join(draw.choices(["#", "#", ";", ",", " ", "1", "A", "Bé", "\t", "\n", "\u2028"], k=draw.randint(0, 40)))
             for _ in range(800)]
    want = [_brute_countries(text) for text in texts]
    assert _values(spark, texts, fn.mentioned_countries(F.col("text"))) == want

    pairs = [[tuple(sorted(p)) for p in itertools.combinations(names, 2)] for names in want]
    got = _values(spark, texts, fn.country_pairs(fn.mentioned_countries(F.col("text"))))
    assert [[tuple(p) for p in row] for row in got] == pairs

    rows = spark.createDataFrame(list(enumerate(want)), "i int, names array<string>")
    exploded = sorted(tuple(r) for r in explode_pairs(rows, "names").collect())
    assert exploded == sorted((i, *p) for i, row in enumerate(pairs) for p in row)


def test_number_of_pairs(spark):
    names = [f"N{i:03d}" for i in range(300)]
    rows = spark.createDataFrame([(names,)], "names array<string>")
    assert explode_pairs(rows, "names").count() == 300 * 299 // 2
