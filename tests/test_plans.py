"""What the plans must and must not contain."""

import re

import pytest

from newsmart import plans
from newsmart.bridge.queries import QUERIES
from newsmart.schemas import MARTS
from newsmart.sources import read_mart

SF_DIR = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _key_plan(spark, key):
    return _plan(QUERIES[key](spark, SF_DIR))


@pytest.mark.parametrize("key", list(QUERIES))
def test_no_python_and_no_nested_loops(spark, key):
    plan = _key_plan(spark, key)
    for node in ("Python", "InArrow", "InPandas", "BroadcastNestedLoopJoin", "CartesianProduct", "Existing RDD"):
        assert node not in plan
    # A global count, least or greatest ends in one row, after a partial aggregate.
    assert "SinglePartition" not in plan or key in ("mart_counts", "pair_grid")


@pytest.mark.parametrize("key, exchanges", [
    ("parse_events", 0), ("location_pairs", 0), ("best_mention", 1), ("a_language_counts", 4), ("c_theme", 1),
    ("c_person", 1), ("c_country", 1), ("d_country_pairs", 1), ("d_monthly", 2), ("sql_events_per_day", 1)])
def test_shuffles(spark, key, exchanges):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert _key_plan(spark, key).count("Exchange hashpartitioning") == exchanges
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_only_read_fields_are_evaluated(spark):
    plan = _key_plan(spark, "sql_events_per_day")
    assert plan.count("split(") == 1 and "RLIKE" not in plan


def test_lists_are_built_once(spark):
    assert _key_plan(spark, "d_country_pairs").count("array_distinct") == 1
    assert _key_plan(spark, "c_theme").count(", ;, -1)") == 1


@pytest.mark.parametrize("key", ["serve_a_topk", "serve_a_topk_skip", "serve_a_choropleth"])
def test_top_rows_need_no_full_sort(spark, key):
    assert "TakeOrderedAndProject" in _key_plan(spark, key)


def test_stored_mart_lookups_are_pushed_down(spark, tmp_path):
    path = str(tmp_path / "a")
    rows = [(20190101 + i % 28, f"C{i % 9}", "fra", i) for i in range(200)]
    spark.createDataFrame(rows, MARTS["querya"].schema).write.parquet(path)
    mart = read_mart(spark, path, "querya")

    def pushed(df):
        return re.search(r"PushedFilters: \[(.*?)\], ReadSchema", _plan(df)).group(1)

    assert "EqualTo(sqldate,20190105)" in pushed(plans.day_slice(mart, "20190105"))
    assert "EqualTo(country,C1)" in pushed(plans.rows_of_country(mart, "C1"))
    series = plans.country_series(mart, "C1", "2019-01-05", "2019-01-12")
    assert "GreaterThanOrEqual(sqldate,20190105)" in pushed(series) and "LessThan(sqldate,20190112)" in pushed(series)
    assert {r.sqldate for r in series.collect()} <= set(range(20190105, 20190112))
    assert series.count() == mart.where("country = 'C1' AND sqldate BETWEEN 20190105 AND 20190111").count() > 0

    d = [(1, 1, 2019, 5, 1.0, "NATION_1", "NATION_2")]
    spark.createDataFrame(d, MARTS["queryd2"].schema).write.parquet(str(tmp_path / "d"))
    pairs = read_mart(spark, str(tmp_path / "d"), "queryd2")
    assert "EqualTo(country1,NATION_1)" in pushed(plans.rows_of_pair(pairs, "NATION_1", "NATION_2"))
    assert "In(country1, " in pushed(plans.watchlist_grid(pairs, months=(1,)))


def test_mart_b_is_one_branch(spark):
    plan = _key_plan(spark, "b_event_mentions").split("Initial Plan")[0]
    assert plan.count("Union") == 1 and "Join" not in plan and "Broadcast" not in plan


def test_the_grid_builds_its_mart_once(spark):
    plan = _key_plan(spark, "pair_grid").split("Initial Plan")[-1]
    assert plan.count("Scan parquet") == 1
