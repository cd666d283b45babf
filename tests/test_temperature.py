"""Station temperatures against a plain join of every pair."""

import datetime as dt
import random

import pytest

from almanack import plans as P
from almanack.schemas import MEASUREMENT
from plans_text import plan

STATIONS = [("S1", 1.0, 2.0, "one"), ("S2", 3.0, 4.0, "two"), ("S3", 5.0, 6.0, "three")]


@pytest.fixture(scope="module")
def stations(spark):
    return spark.createDataFrame(STATIONS, "sid string, lat double, lon double, name string")


def day(n):
    return dt.date(2018, 1, 1) + dt.timedelta(n)


def by_pairs(rows):
    """Means over all pairs; None for a station whose pairs have no values."""
    sums = {}
    for s, d, m, hi in rows:
        for s2, d2, m2, lo in rows:
            if (s, d, m, m2) == (s2, d2, "TMAX", "TMIN") and s in {x[0] for x in STATIONS}:
                pairs = sums.setdefault(s, [])
                if hi is not None and lo is not None:
                    pairs.append((hi + lo) / 20 * 1.8 + 32)
    return {s: sum(p) / len(p) if p else None for s, p in sums.items()}


def check(found, wanted):
    assert found.columns == ["sid", "tave", "lat", "lon", "name"]
    means = {r.sid: r.tave for r in found.collect()}
    assert means.keys() == wanted.keys()
    for sid, mean in wanted.items():
        assert means[sid] == (None if mean is None else pytest.approx(mean, rel=1e-12))


def both_forms(spark, rows, stations, **options):
    data = spark.createDataFrame(rows, MEASUREMENT).repartition(3)
    yield P.station_temperature(data, stations, **options)
    yield P.station_temperature_sql(spark, data, stations, **options)


ROWS = [
    ("S1", day(0), "TMAX", 300.0),
    ("S1", day(0), "TMIN", 100.0),
    ("S1", day(0), "PRCP", 999.0),
    ("S1", day(1), "TMAX", 310.0),  # no minimum on this day
    ("S2", day(0), "TMAX", 200.0),  # two maxima, two minima: four pairs
    ("S2", day(0), "TMAX", 240.0),
    ("S2", day(0), "TMIN", 10.0),
    ("S2", day(0), "TMIN", None),
    ("S2", day(5), "TMAX", -20.0),
    ("S2", day(5), "TMIN", -80.0),
    ("S3", day(0), "TMAX", None),  # a pair without values
    ("S3", day(0), "TMIN", 10.0),
    ("S4", day(0), "TMAX", 1.0),  # not a known station
    ("S4", day(0), "TMIN", 1.0),
]


def test_pairs_nulls_and_stations(spark, stations):
    wanted = by_pairs(ROWS)
    assert wanted["S3"] is None and wanted["S1"] == pytest.approx(68.0)
    for found in both_forms(spark, ROWS, stations):
        check(found, wanted)


def test_one_station_and_day_with_a_third_of_the_rows(spark, stations):
    rnd = random.Random(1)
    rows = [
        (
            "S1" if i % 3 == 0 else rnd.choice(["S1", "S2", "S3"]),
            day(0) if i % 3 == 0 else day(rnd.randint(0, 30)),
            rnd.choice(["TMAX", "TMIN", "SNOW"]),
            rnd.choice([None, 10.0 * rnd.randint(-30, 30)]),
        )
        for i in range(900)
    ]
    for found in both_forms(spark, rows, stations):
        check(found, by_pairs(rows))


def test_limit_takes_the_first_of_each_kind(spark, stations):
    order = sorted((r for r in ROWS if r[3] is not None), key=lambda r: (r[0], r[1], r[3]))
    kept = [r for kind in ("TMAX", "TMIN") for r in [x for x in order if x[2] == kind][:2]]
    for found in both_forms(spark, order, stations, limit=2):
        check(found, by_pairs(kept))


def test_limit_makes_no_top_n(spark, stations):
    rows = [(f"S{i % 3 + 1}", day(i), kind, float(i)) for i in range(40) for kind in ("TMAX", "TMIN")]
    for found in both_forms(spark, rows, stations, limit=25):
        text = plan(found)
        assert "TakeOrdered" not in text and "GlobalLimit" not in text
