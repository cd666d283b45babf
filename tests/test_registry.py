"""Every registered query against its SQL, and what its plan must not hold."""

import re

import pytest

import __spark_entry__ as contract
from almanack.registry import ORACLES, QUERIES, standins
from compare import difference, oracle
from conftest import DATA
from plans_text import plan


@pytest.fixture(scope="module")
def con():
    return oracle(f"{DATA}/sf0.01")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_agrees_with_sql(spark, con, name):
    assert difference(QUERIES[name](spark, f"{DATA}/sf0.01"), con, ORACLES[name]) is None


@pytest.mark.parametrize(
    "name",
    [
        "weekly_consumption",
        "weekly_consumption_sql",
        "weekly_report_pivot",
        "station_temperature",
        "station_temperature_sql",
        "cluster_climate_profile",
        "max_decade_by_area",
        "county_rates_located",
        "join_contains",
        "join_nested_pair",
        "limit_before_join",
        "kmeans_assign_many",
        "station_cluster_profile",
    ],
)
def test_agrees_without_broadcasts(spark, settings, monkeypatch, con, name):
    """Tables too large to broadcast are shuffled, with the same result."""
    monkeypatch.setattr("pyspark.sql.functions.broadcast", lambda df: df)
    off = {"spark__sql__autoBroadcastJoinThreshold": -1, "spark__sql__shuffle__partitions": 3}
    adaptive_off = {"spark__sql__adaptive__autoBroadcastJoinThreshold": -1}
    with settings(**off, **adaptive_off):
        df = QUERIES[name](spark, f"{DATA}/sf0.01")
        assert difference(df, con, ORACLES[name]) is None
        assert "BroadcastHashJoin" not in plan(df)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_cross_join_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, f"{DATA}/sf0.001"))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "InPandas", "Window"):
        assert operator not in text, text


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_query_is_empty(spark, name):
    assert not QUERIES[name](spark, f"{DATA}/sf0.01").isEmpty()


def test_sales_meet_in_weeks_and_days_span_years(spark):
    sf_dir = f"{DATA}/sf0.01"
    assert QUERIES["weekly_consumption"](spark, sf_dir).count() <= 6_000
    assert QUERIES["monthly_averages"](spark, sf_dir).count() == 12
    assert standins.weather_days(spark, sf_dir).select("year").distinct().count() > 3


def test_contract(spark):
    assert contract.queries().keys() >= contract.oracle_sql().keys()
    flagship = contract.entry(spark)
    assert flagship.columns == ["id", "sales_units", "net_sales"]
    assert flagship.count() > 0


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["filter_equality"](spark, f"{DATA}/sf0.001"), "formatted")
    assert "EqualTo(event_type,view)" in text
    assert "struct<event_id:bigint,user_id:bigint,event_type:string,value:double>" in text
    text = plan(QUERIES["join_nested_pair"](spark, f"{DATA}/sf0.001"), "formatted")
    assert "struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double>" in text
    assert "struct<c_custkey:bigint,c_name:string>" in text


def test_weekly_consumption_shuffles_the_sales_once(spark):
    text = plan(QUERIES["weekly_consumption"](spark, f"{DATA}/sf0.001"))
    assert text.count("Exchange hashpartitioning(short_year") == 1
    assert text.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize(
    "name", ["weekly_consumption", "weekly_consumption_sql", "weekly_report_pivot"]
)
def test_each_dimension_is_computed_once(spark, name):
    """What stands for calendar, stores and products is written once; the plan reads that."""
    text = plan(QUERIES[name](spark, f"{DATA}/sf0.001"), "formatted")
    assert len(set(re.findall(r"almanack-[0-9a-f]+/dimension", text))) == 3
    assert text.count("/dimension") == 3


@pytest.mark.parametrize(
    "name", ["weekly_consumption", "weekly_consumption_sql", "weekly_report_pivot"]
)
def test_sales_are_not_shuffled_by_day(spark, settings, name):
    with settings(spark__sql__autoBroadcastJoinThreshold=-1):
        assert "hashpartitioning(date_id" not in plan(QUERIES[name](spark, f"{DATA}/sf0.001"))


def test_profile_of_all_clusters_is_one_shuffle(spark):
    text = plan(QUERIES["cluster_climate_profile"](spark, f"{DATA}/sf0.001"))
    assert text.count("Exchange hashpartitioning") == 1
    assert "SortAggregate" not in text
