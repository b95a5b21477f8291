import random
from collections import Counter

import pytest

from pyspark.sql import functions as F

from newsmart import functions as fn
from newsmart import operators as op
from newsmart import commits, plans
from newsmart.operators.filters import ALIAS_PAIRS, WATCHLIST
from newsmart.schemas import MARTS
from newsmart.plans.jobs import store_marts
from newsmart.sinks import merge_mart, to_mart_schema, write_mart, write_period
from newsmart.sources import read_mart

EVENTS = "GLOBALEVENTID int, SQLDATE string, ActionGeo_CountryCode string, Year int"
MENTIONS = ("GLOBALEVENTID int, Confidence int, MentionTimeDate long, MentionIdentifier string, SentenceID int, "
            "SRCLC string")
GKG = "GKGRECORDID string, DATE long, SourceCommonName string, Themes string, Persons string, V2Locations string, " \
      "V2Tone string"


def _feed(spark, seed=3, hot=400):
    """Events of which one id holds more than a third, and mentions likewise."""
    draw = random.Random(seed)
    ids = [0] * hot + [draw.randint(1, 600) for _ in range(600)]
    events = [(i, f"2019010{draw.randint(1, 3)}", draw.choice(["FR", "US", ""]), 2019) for i in ids]
    mentions = [(draw.choice([0, draw.randint(1, 800)]), draw.randint(1, 3), draw.randint(1, 3), draw.choice("ab"),
                 draw.randint(1, 2), draw.choice(["fra", "", "deu"])) for _ in range(2000)]
    return events, mentions, spark.createDataFrame(events, EVENTS), spark.createDataFrame(mentions, MENTIONS)


def test_mart_a_matches_brute_force(spark):
    events, mentions, e, m = _feed(spark)
    best = {}
    for i, confidence, when, url, sentence, language in mentions:
        rank = (-confidence, when, url, sentence, language)
        best[i] = min(best.get(i, rank), rank)
    want = Counter((d, c, best[i][-1] if i in best else None) for i, d, c, _ in events)
    got = plans.best_language_counts(e, m).collect()
    assert {(r.sqldate, r.country, r.language): r["count"] for r in got} == want
    assert sum(r["count"] for r in got) == len(events)


def test_mart_b_matches_brute_force_with_hot_ids(spark):
    events, mentions, e, m = _feed(spark)
    copies, mentioned = Counter(i for i, *_ in events), Counter(i for i, *_ in mentions)
    want = Counter((i, d, copies[i] * max(mentioned[i], 1), mentioned[i], c, 2019, d[4:6], d[6:]) for i, d, c, _ in events)
    assert Counter(map(tuple, plans.event_mentions(e, m).collect())) == want


def test_repeated_rows_come_back_in_blocks(spark):
    df = spark.createDataFrame([("a", 25), ("b", 1), ("c", 10)], "name string, copies long")
    got = Counter(r.name for r in op.repeat_rows(df, "copies", block=10).collect())
    assert got == {"a": 25, "b": 1, "c": 10}


def test_mart_b_reads_its_inputs_once(spark):
    *_, e, m = _feed(spark)
    reads = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)

    def counting(df, reads):
        def count(batches):
            for batch in batches:
                reads.add(batch.num_rows)
                yield batch
        return df.mapInArrow(count, df.schema)

    plans.event_mentions(counting(e, reads[0]), counting(m, reads[1])).collect()
    assert [x.value for x in reads] == [e.count(), m.count()]


def test_exact_mean_in_any_order(spark):
    values = [0.1, 1e16, 0.3, -1e16, 7.7] * 20
    means = {spark.createDataFrame([(v,) for v in some], "t double").select(fn.exact_mean("t")).first()[0]
             for some in (values, values[::-1], sorted(values))}
    assert len(means) == 1 and abs(means.pop() - 1.62) < 1e-9
    odd = spark.createDataFrame([(1, float("inf")), (1, 2.0), (2, float("nan")), (2, 1.0), (3, None), (4, 1e300)],
                                "k int, t double").groupBy("k").agg(fn.exact_mean("t").alias("m"))
    got = {r.k: r.m for r in odd.collect()}
    assert got[1] == float("inf") and got[2] != got[2] and got[3] is None and got[4] == 1e300


def test_copied_id_multiplies_its_count(spark):
    e = spark.createDataFrame([(1, "20190101", "FR", 2019)] * 2, EVENTS)
    m = spark.createDataFrame([(1, 1, 1, "u", 1, "")] * 3, MENTIONS)
    assert [(r["count"], r.true_mentions) for r in plans.event_mentions(e, m).collect()] == [(6, 3)] * 2


def test_best_mention_takes_any_confidence(spark):
    m = spark.createDataFrame([(1, -2**31, 1, "u", 1, "a"), (1, -5, 1, "u", 1, "b")], MENTIONS)
    assert op.best_mention(m, ("SRCLC", "Confidence")).collect()[0].SRCLC == "b"


def _articles(spark, *rows):
    base = dict(GKGRECORDID="g", DATE=20190115093000, SourceCommonName="s", Themes="", Persons="", V2Locations="",
                V2Tone="1")
    columns = [part.split()[0] for part in GKG.split(", ")]
    return spark.createDataFrame([tuple((base | row)[c] for c in columns) for row in rows], GKG)


def test_blank_items_and_bad_tones(spark):
    gkg = _articles(spark, {"Themes": "A;A;"}, {"Themes": "A", "V2Tone": "3,1"}, {"Themes": "A", "V2Tone": "x"},
                    {"Themes": "", "V2Tone": "NaN"}, {})
    rows = {r.theme: (r.nbarticle, r.tonemean, r.month) for r in plans.theme_tone(gkg).collect()}
    assert rows == {"A": (3, 5 / 3, "0115"), "": (2, 1.0, "0115")}
    rows = {r.theme: r.month for r in plans.theme_tone(gkg, skip_blank=True, calendar_months=True).collect()}
    assert rows == {"A": "01"}


def test_pairs_keep_articles_without_tone(spark):
    where = "1#Chad#CD#x;1#Peru#PE#x;1#Chad#CD#y"
    rows = plans.country_pair_tone(_articles(spark, {"V2Locations": where, "V2Tone": "x"})).collect()
    assert [(r.country1, r.country2, r.n_articles, r.mean_tone) for r in rows] == [("Chad", "Peru", 0, None)]
    assert plans.country_tone(_articles(spark, {"V2Locations": where})).count() == 2


def test_monthly_mean_is_over_days(spark):
    d = spark.createDataFrame([("a", "b", 1, 1.0, 1), ("a", "b", 1, 4.0, 9)],
                              "country1 string, country2 string, month int, mean_tone double, n_articles int")
    assert plans.monthly_pairs(d).collect()[0].mean_tone == 2.5
    weighted = plans.monthly_pairs(d.withColumn("tone_sum", F.col("mean_tone") * F.col("n_articles"))).collect()[0]
    assert weighted.weighted_tone == 3.7


def test_rollup_levels_agree(spark):
    *_, e, m = _feed(spark)
    rows = plans.event_rollup(plans.event_mentions(e, m)).collect()
    totals = {level: sum(r.events for r in rows if r.level == level) for level in ("day", "month", "year")}
    assert totals == dict.fromkeys(("day", "month", "year"), 1000)
    assert all((r.day is None) == (r.level != "day") and (r.month is None) == (r.level == "year") for r in rows)


def test_aliases_and_watchlist(spark):
    pairs = spark.createDataFrame(
        [*ALIAS_PAIRS, ("China", "France"), ("France", "China"), ("Chad", "Iran")], "country1 string, country2 string")
    assert op.exclude_pairs(pairs).count() == 3
    assert op.exclude_pairs(pairs, ()).count() == 10
    assert [tuple(r) for r in op.keep_watchlist(op.exclude_pairs(pairs)).collect()] == [("China", "France")]


def test_grid_defaults(spark):
    d = spark.createDataFrame(
        [(1, 1, 2019, 50, -2.0, "China", "France"), (1, 1, 2019, 10, 1.0, "China", "Iran"),
         (1, 2, 2019, 20, -0.5, "China", "France")],
        MARTS["queryd2"].schema)
    rows = {(r.country1, r.country2): r for r in plans.watchlist_grid(d, months=(1, 2)).collect()}
    assert len(rows) == (len(WATCHLIST) - 1) ** 2
    hit, other, empty = rows["China", "France"], rows["China", "Iran"], rows["Russia", "France"]
    assert (hit.bucket_1, hit.size_1, hit.mean_tone_1, hit.n_articles_1) == (0, 125, -2.0, 50)
    assert (hit.bucket_2, hit.size_2) == (4, 50)
    assert (other.bucket_1, other.size_1, other.bucket_2, other.n_articles_2) == (9, 25, 5, 0)
    assert (empty.bucket_1, empty.size_1, empty.mean_tone_1, empty.n_articles_1) == (5, 0, 0.0, 0)


def test_grid_of_one_row_has_no_spread(spark):
    d = spark.createDataFrame([(1, 1, 2019, 50, -2.0, "China", "France")], MARTS["queryd2"].schema)
    row = plans.watchlist_grid(d, months=(1,)).where("n_articles_1 > 0").collect()[0]
    assert (row.bucket_1, row.size_1, row.mean_tone_1) == (5, 0, -2.0)


def test_without_top_row_on_nulls(spark):
    df = spark.createDataFrame([("1", "FR", None, 9), ("1", "FR", "", 9), ("1", "US", "fra", 1), ("2", "FR", None, 8)],
                               "sqldate string, country string, language string, count int")
    assert {tuple(r) for r in plans.ranked_from_second(df).collect()} == {
        ("1", "FR", "", 9), ("1", "US", "fra", 1), ("2", "FR", None, 8)}
    assert plans.ranked_from_second(df.limit(0)).count() == 0


def test_collapse_to_key(spark):
    df = spark.createDataFrame([(1, "FR", "a", 5), (1, "FR", None, 5), (1, "FR", "b", 7)], "sqldate int, country string, "
                               "language string, count int")
    rows = op.collapse_to_key(df, ["sqldate", "country", "count"])
    assert rows.columns == df.columns
    assert {tuple(r) for r in rows.collect()} == {(1, "FR", "a", 5), (1, "FR", "b", 7)}


def test_mart_types(spark):
    df = spark.createDataFrame([("01", "x", "2019", 5, 1.25, "a", "b", "more")],
                               "day string, month string, year string, n_articles long, mean_tone double, "
                               "country1 string, country2 string, extra string")
    out = to_mart_schema(df, "queryd2")
    assert tuple(out.collect()[0]) == (1, None, 2019, 5, 1.25, "a", "b")
    for wrong in ({"n_articles": 3_000_000_000}, {"year": "x"}):
        with pytest.raises(Exception, match="does not fit"):
            to_mart_schema(df.withColumns({k: F.lit(v) for k, v in wrong.items()}), "queryd2").collect()
    assert [f.dataType for f in out.schema] == [f.dataType for f in MARTS["queryd2"].schema]


def test_parquet_layout(spark, tmp_path):
    # one theme holds most rows; it must not end up in one file, and rows must come back in key and count order
    rows = [(20190101, "2019", "0101", "01", "s", "" if i % 4 else f"T{i % 50:02d}", i, 1.0) for i in range(40_000)]
    path = str(tmp_path / "c")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else rows this few share a file
    try:
        write_mart(spark.createDataFrame(rows, MARTS["queryctheme"].schema).repartition(4), "queryctheme", path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    back = read_mart(spark, path, "queryctheme")
    per_file = back.where("theme = ''").groupBy(F.input_file_name().alias("file")).count().collect()
    assert len(per_file) > 1
    in_file = back.select(F.input_file_name().alias("file"), "theme", "nbarticle").collect()
    for name in {r.file for r in in_file}:
        keys = [(r.theme, -r.nbarticle) for r in in_file if r.file == name]
        assert keys == sorted(keys)
    assert {tuple(r) for r in back.collect()} == set(rows)


def test_csv_has_mart_columns_and_no_header(spark, tmp_path):
    path = str(tmp_path / "a")
    df = spark.createDataFrame([(3, "", "FR", "20190101"), (4, None, "a,b", "20190102")],
                               "count long, language string, country string, sqldate string")
    write_mart(df, "querya", path, "csv")
    text = sorted(line for f in (tmp_path / "a").glob("*.csv") for line in f.read_text().splitlines())
    assert text == ['20190101,FR,"",3', '20190102,"a,b",,4']
    assert {tuple(r) for r in read_mart(spark, path, "querya", "csv").collect()} >= {(20190102, "a,b", None, 4)}


def _drawn_articles(spark):
    draw = random.Random(11)
    rows = [(str(i), int(f"2019{draw.randint(1, 3):02d}{draw.randint(1, 28):02d}000000"), draw.choice("ab"),
             draw.choice(["A;B;", "", "A;A"]), draw.choice(["p", "p;q", ""]),
             ";".join(f"1#{name}#x#" for name in draw.sample(["France", "Chad", "Peru", " "], draw.randint(0, 4))),
             draw.choice(["1,2", "-3", "x", "", "2.5,1"])) for i in range(400)]
    rows += [("bad", 0, "a", "A", "p", "1#France#x#;1#Chad#x#", "4")]
    return spark.createDataFrame(rows, GKG)


def test_item_marts_from_one_scan(spark):
    gkg = _drawn_articles(spark)
    both = plans.item_tones(gkg)
    alone = {"theme": plans.theme_tone(gkg), "person": plans.person_tone(gkg), "country": plans.country_tone(gkg)}
    for kind, mart in alone.items():
        got = plans.of_kind(both, kind)
        assert got.columns == mart.columns
        assert Counter(map(tuple, got.collect())) == Counter(map(tuple, mart.collect()))
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_item_marts_are_stored_from_one_read(spark, tmp_path):
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    gkg = _drawn_articles(spark)
    watched = gkg.mapInArrow(seen, gkg.schema)
    store_marts(lambda kind: watched, ["queryctheme", "querycperson", "queryccountry"], str(tmp_path), period="2019")
    assert reads.value == gkg.count() and not list(tmp_path.glob("_staging*"))
    for name, mart in (("queryctheme", plans.theme_tone(gkg)), ("queryccountry", plans.country_tone(gkg))):
        want = Counter(map(tuple, to_mart_schema(mart, name).collect()))
        assert Counter(map(tuple, read_mart(spark, str(tmp_path / name), name).collect())) == want


def test_the_monthly_roll_up_grows_by_a_day(spark, tmp_path):
    mart_d = plans.country_pair_tone(_drawn_articles(spark)).cache()
    target = str(tmp_path / "queryd2monthly")

    def rebuilt(rows):
        return Counter(map(tuple, to_mart_schema(plans.monthly_pairs(rows), "queryd2monthly").collect()))

    def of(*months):
        return mart_d.where(F.col("month").isin(list(months)))

    assert plans.refresh_monthly(of("01"), target, "201901") == [1]
    assert plans.refresh_monthly(of("02").where("day < '20'"), target, "20190219") == [2]
    january = {p for p in (tmp_path / "queryd2monthly" / "mart").rglob("part=1/*.parquet")}
    assert plans.refresh_monthly(of("02").where("day = '20'"), target, "20190220") == [2]  # given that day alone
    assert {p for p in (tmp_path / "queryd2monthly" / "mart").rglob("part=1/*.parquet")} == january
    assert Counter(map(tuple, plans.read_monthly(spark, target).collect())) == rebuilt(
        of("01", "02").where("month = '01' OR day <= '20'"))
    # a period made again replaces its part; undated rows are a month of their own
    assert plans.refresh_monthly(of("02").where("day = '21'").unionAll(mart_d.where("month = ''")), target, "20190220") == [-1, 2]
    assert Counter(map(tuple, plans.read_monthly(spark, target).collect())) == rebuilt(
        of("01", "02").where("month = '01' OR day < '20' OR day = '21'").unionAll(mart_d.where("month = ''")))
    assert plans.refresh_monthly(mart_d.limit(0), target, "20190220") == [-1, 2]
    with pytest.raises(ValueError, match="overlaps"):
        plans.refresh_monthly(of("01"), target, "2019")
    with pytest.raises(FileNotFoundError):
        plans.read_monthly(spark, str(tmp_path / "none"))


def _pairs(spark, rows):
    return spark.createDataFrame(rows, "day int, month int, year int, n_articles int, mean_tone float, country1 string, country2 string")


def test_rows_are_merged_by_key(spark, tmp_path):
    target = str(tmp_path / "querya")

    def mart(rows):
        return spark.createDataFrame(rows, "sqldate int, country string, language string, count int")

    first = [(20190101 + day, f"C{n:02d}", "fra", n) for day in range(20) for n in range(40)]
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # else so few rows are one file
    try:
        assert merge_mart(mart(first), "querya", target) == (0, 8)
        before = set(read_mart(spark, target, "querya").inputFiles())
        # the same key with another language, a key of its own, two rows of one key
        new = [(20190103, "C05", "deu", 5), (20190103, "C05", "deu", 6), (20190103, None, "x", 1), (20190104, "D", "a", 2),
               (20190104, "D", "b", 2)]
        replaced, _ = merge_mart(mart(new), "querya", target)
        want = {(d, c, n): l for d, c, l, n in first} | {(d, c, n): l for d, c, l, n in new}
        got = read_mart(spark, target, "querya").collect()
        assert {(r.sqldate, r.country, r["count"]): r.language for r in got} == want and len(got) == len(want)
        assert replaced == 1 and len(before - set(read_mart(spark, target, "querya").inputFiles())) == 1
        # overlapping periods: merging the first again changes back what it holds and keeps the rest
        merge_mart(mart(first), "querya", target)
        got = read_mart(spark, target, "querya").collect()
        assert {(r.sqldate, r.country, r["count"]): r.language for r in got} == want | {(d, c, n): l for d, c, l, n in first}
        assert merge_mart(mart([]), "querya", target)[0] == 0 and read_mart(spark, target, "querya").count() == len(want)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_a_lost_merge_changes_nothing(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "d")
    merge_mart(_pairs(spark, [(1, 1, 2019, 5, 1.0, "A", "B")]), "queryd2", target)
    with monkeypatch.context() as patch:
        patch.setattr(commits, "move", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            merge_mart(_pairs(spark, [(2, 1, 2019, 5, 1.0, "A", "B")]), "queryd2", target)
    assert [r.day for r in read_mart(spark, target, "queryd2").collect()] == [1]
    merge_mart(_pairs(spark, [(2, 1, 2019, 5, 1.0, "A", "B"), (3, 1, 2019, 5, 1.0, "A", None)]), "queryd2", target)
    assert sorted(r.day for r in read_mart(spark, target, "queryd2").collect()) == [2, 3]


def test_a_period_lost_between_two_moves_comes_back(spark, tmp_path):
    target = tmp_path / "d"
    rows = _pairs(spark, [(1, 1, 2019, 5, 1.0, "A", "B")])
    write_period(rows, "queryd2", str(target), "2019")
    (target / "period=2019").rename(target / "_before-2019")  # where a lost run left it
    with pytest.raises(ValueError, match="no rows"):
        write_period(rows.limit(0), "queryd2", str(target), "2019")
    assert (target / "_before-2019").exists()  # nothing was lost
    write_period(_pairs(spark, [(2, 1, 2019, 5, 1.0, "A", "B")]), "queryd2", str(target), "2019")
    assert [r.day for r in read_mart(spark, str(target), "queryd2").collect()] == [2]
    assert not (target / "_before-2019").exists()


def test_lookups_stop_at_their_limit(spark):
    gkg = _drawn_articles(spark)
    events, mentions, e, m = _feed(spark)
    lookups = [lambda limit: plans.rows_of_country(plans.event_mentions(e, m), "FR", limit),
               lambda limit: plans.rows_of_item(plans.theme_tone(gkg), "theme", "A", limit),
               lambda limit: plans.rows_of_pair(plans.country_pair_tone(gkg), "Chad", "Peru", limit)]
    for lookup in lookups:
        everything = lookup(None).collect()
        assert len(everything) > 7 and lookup(7).collect() == everything[:7] and lookup(0).collect() == []
        assert lookup(10 ** 6).collect() == everything
    country_rows = plans.rows_of_country(plans.best_language_counts(e, m), "FR", 3).collect()
    assert len(country_rows) == 3 and {r.country for r in country_rows} == {"FR"}
