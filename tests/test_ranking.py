"""First rows, positions and samples, against sorted lists."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from almanack import operators as O
from almanack.operators import ranking
from plans_text import plan

SCHEMA = "n int, day date, x double, note string"


def rows(count, seed=1):
    """A third of the rows share one key; some rows repeat; keys are NULL at times."""
    rnd = random.Random(seed)
    out = [
        (
            rnd.choice([None, 5, 5, 5, rnd.randint(0, 9)]),
            rnd.choice([None, dt.date(2017, 1, 1) + dt.timedelta(rnd.randint(0, 9))]),
            rnd.choice([None, float("-inf"), -0.5, rnd.random()]),
            rnd.choice(["a", "b"]),
        )
        for _ in range(count)
    ]
    return out + [(5, None, None, "same")] * (count // 3)


def order_of(row):
    return tuple((v is not None, 0 if v is None else v) for v in row[:3])


@pytest.mark.parametrize("n", [0, 1, 37, 200, 333, 399, 400, 1000])
def test_first_rows_are_those_of_a_sort(spark, n):
    data = rows(300)
    df = spark.createDataFrame(data, SCHEMA).repartition(7)
    found = O.first_rows(df, n, "n", "day", "x")
    assert found.columns == df.columns
    got = [tuple(r) for r in found.collect()]
    assert sorted(map(order_of, got)) == sorted(map(order_of, data))[:n]
    for row in set(got):
        assert got.count(row) <= data.count(row)


def test_first_rows_need_no_top_n(spark):
    """Also a million of them; only keys are sorted, and none meet in one task."""
    df = spark.range(1_500_000).select((F.col("id") * 7919 % 1_500_007).alias("n"), F.lit("x").alias("note"))
    found = O.first_rows(df, 1_000_000, "n")
    text = plan(found)
    for operator in ("TakeOrdered", "GlobalLimit", "CollectLimit"):
        assert operator not in text
    assert found.count() == 1_000_000
    edge = sorted(i * 7919 % 1_500_007 for i in range(1_500_000))[999_999]
    assert found.agg(F.max("n")).first()[0] == edge


def test_repeated_rows_at_the_boundary_are_counted(spark):
    df = spark.createDataFrame([(1, "a")] * 10 + [(0, "b")] * 3, "n int, note string").repartition(4)
    found = O.first_rows(df, 7, "n").collect()
    assert sorted(r.note for r in found) == ["a"] * 4 + ["b"] * 3
    assert O.first_rows(df.limit(0), 7, "n").collect() == []


def test_positions_are_row_numbers(spark):
    data = [(i * 37 % 101, f"w{i}") for i in range(101)]
    df = spark.createDataFrame(data, "n int, note string").repartition(5)
    placed = O.with_positions(df, F.desc("n"))
    assert "Window" not in plan(placed)
    got = sorted((r.position, r.n, r.note) for r in placed.collect())
    assert got == [(i + 1, *row) for i, row in enumerate(sorted(data, reverse=True))]
    assert O.with_positions(df.limit(0), "n").collect() == []


def test_positions_of_a_hot_key_are_a_permutation(spark):
    df = spark.createDataFrame(rows(200), SCHEMA).repartition(6)
    placed = O.with_positions(df, "n", "day", position="place")
    got = sorted((r.place, order_of((r.n, r.day, None))) for r in placed.collect())
    assert [p for p, _ in got] == list(range(1, df.count() + 1))
    assert [o for _, o in got] == sorted(o for _, o in got)


def test_samples_do_not_depend_on_partitions(spark):
    df = spark.range(20_000).select(F.col("id").alias("k"), (F.col("id") % 5).alias("v"))
    drawn = {r.k for r in O.sample_by_key(df, 0.1, "k", seed=3).collect()}
    assert drawn == {r.k for r in O.sample_by_key(df.repartition(9, "v"), 0.1, "k", seed=3).collect()}
    assert 1_800 < len(drawn) < 2_200
    assert drawn <= {r.k for r in O.sample_by_key(df, 0.2, "k", seed=3).collect()}
    assert drawn != {r.k for r in O.sample_by_key(df, 0.1, "k", seed=4).collect()}
    assert O.sample_by_key(df, 0.0, "k").count() == 0 and O.sample_by_key(df, 1.0, "k").count() == 20_000


def test_samples_of_tables_that_share_a_key_agree(spark):
    left = spark.createDataFrame([(None, 1), *((i, 1) for i in range(50))], "k int, a int")
    right = left.select(F.col("k").cast("long").alias("k"), F.lit("x").alias("b"))
    drawn = [sorted(str(r.k) for r in O.sample_by_key(t, 0.5, "k").collect()) for t in (left, right)]
    assert drawn[0] == drawn[1] and 10 < len(drawn[0]) < 41


def test_parts_of_a_share(spark):
    low, high = spark.range(5000).agg(F.min(O.key_share("id")), F.max(O.key_share("id"))).first()
    assert 0 <= low < high < ranking.SHARE_PARTS
