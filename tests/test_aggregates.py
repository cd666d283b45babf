import random
import struct

import pytest
from pyspark.sql import functions as F

from almanack import operators as O
from almanack.operators.aggregates import order_bits
from plans_text import plan


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_argmax_takes_the_smaller_label_on_a_tie(spark):
    df = spark.createDataFrame(
        [
            ("a", 1990, 5.0),
            ("a", 2000, 5.0),
            ("a", 2010, 4.0),
            ("b", 2000, -1.0),
            ("c", 1990, None),
        ],
        "k string, decade int, mean double",
    )
    found = O.argmax_by_key(df, ["k"], "decade", "mean")
    assert found.columns == ["k", "decade", "mean"]
    assert sorted(map(str, found.collect())) == sorted(
        [
            "Row(k='a', decade=1990, mean=5.0)",
            "Row(k='b', decade=2000, mean=-1.0)",
            "Row(k='c', decade=1990, mean=None)",
        ]
    )


def test_rows_at_max_keeps_ties(spark):
    df = spark.createDataFrame([(1, 3.0), (2, 9.0), (3, 9.0), (4, None)], "n int, x double")
    assert rows(O.rows_at_max(df, "x")) == [(2, 9.0), (3, 9.0)]
    assert rows(O.rows_at_max(df.limit(0), "x")) == []


def test_argmax_row(spark):
    df = spark.createDataFrame([(1, 3.0), (2, 9.0), (3, 9.0)], "n int, x double")
    assert rows(O.argmax_row(df, F.desc("x"), F.asc("n"))) == [(2, 9.0)]


def test_share_and_conditional_mean(spark):
    data = [(0.5, 10.0), (1.0, 20.0), (2.0, 40.0), (-1.0, 1.0)]
    df = spark.createDataFrame(data, "p double, x double")
    wet, never = F.col("p") >= 1.0, F.col("p") > 99
    row = df.agg(
        O.share_where(wet), O.mean_where(F.col("x"), wet), O.mean_where(F.col("x"), never)
    ).first()
    assert tuple(row) == (50.0, 30.0, None)


def test_population_and_sample_deviation_differ(spark):
    df = spark.createDataFrame([(1.0,), (3.0,)], "x double")
    row = df.agg(F.stddev_pop("x"), F.stddev_samp("x")).first()
    assert tuple(row) == (pytest.approx(1.0), pytest.approx(2**0.5))


def test_having_counts_rows_with_null_values_too(spark):
    df = spark.createDataFrame(
        [(1, "A", None), (1, "A", 2.0), (1, "B", 1.0), (2, "A", 1.0), (2, "B", 1.0), (3, "A", 1.0)],
        "k int, kind string, x double",
    )
    found = O.having_min_counts(df, ["k"], "kind", {"A": 2, "B": 1})
    assert found.columns == ["k", "n_A", "n_B"]
    assert rows(found) == [(1, 2, 1)]


DOUBLES = [0.0, -0.0, 1.0, 2.0, 0.1, 3.5, 1e300, 1.7976931348623157e308, 2.2250738585072014e-308, 5e-324, 1e-310]
DOUBLES += [2.0**k for k in range(-60, 61, 7)] + [2.0**k * (1 - 2**-53) for k in range(-20, 21)] + [float("inf")]
DOUBLES += [2.0**1023, 2.0**-1022 * (1 - 2**-52), 8.0, 7.999999999999999, 8.000000000000002]


def test_order_bits_order_as_the_doubles(spark):
    values = sorted({*DOUBLES, *(-x for x in DOUBLES)})
    df = spark.createDataFrame([(x,) for x in values], "x double")
    found = {r.x: r.b for r in df.select("x", order_bits(F.col("x")).alias("b")).collect()}
    ordered = [found[x] for x in values]
    assert ordered == sorted(ordered) and len(set(ordered)) == len(values)
    for x in values:
        (bits,) = struct.unpack("<q", struct.pack("<d", abs(x)))
        assert found[x] == (-bits if x < 0 else bits)


def test_argmax_keeps_to_a_hash_table(spark):
    df = spark.createDataFrame([("a", 1990, 5.0)], "k string, decade int, mean double")
    text = plan(O.argmax_by_key(df, ["k"], "decade", "mean"))
    assert text.count("HashAggregate") == 2 and "Sort" not in text


@pytest.mark.parametrize("label", ["int", "bigint"])
def test_argmax_like_brute_force(spark, label):
    """Packed and as a struct alike: NaN is largest, NULL smallest, NULL labels come last."""
    rnd = random.Random(6)
    values = [None, float("nan"), float("inf"), float("-inf"), -0.0, 0.0, 1.5, -1.5, 1.5000000000000002]
    labels = [None, -(2**31), -3, 0, 4, 2**31 - 1]
    data = [(rnd.randint(0, 60), rnd.choice(labels), rnd.choice(values)) for _ in range(300)]
    df = spark.createDataFrame(data, f"k int, decade {label}, mean double").repartition(4)

    def rank(row):
        _, d, m = row
        nan = m is not None and m != m
        return (m is not None, nan, 0.0 if m is None or nan else m + 0.0, d is not None, -(d or 0))

    wanted = {}
    for row in data:
        wanted[row[0]] = max(wanted.get(row[0], row), row, key=rank)
    found = O.argmax_by_key(df, ["k"], "decade", "mean")
    assert dict(found.dtypes)["decade"] == label
    got = {r.k: (r.k, r.decade, r.mean) for r in found.collect()}
    assert {k: rank(v) for k, v in got.items()} == {k: rank(v) for k, v in wanted.items()}
