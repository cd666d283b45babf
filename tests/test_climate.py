"""Cluster profiles against numpy, and the guard on the number of rows."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from almanack import plans as P
from almanack.schemas import CLUSTER_PROFILE
from plans_text import plan

SCHEMA = "cluster int, lat double, lon double, date date, measure string, value double"


def observations(cluster, counts, seed=0, spread=360):
    rnd = random.Random(seed)
    return [
        (
            cluster,
            cluster + rnd.random(),
            rnd.random() * 10,
            dt.date(2017, 1, 1) + dt.timedelta(rnd.randint(0, spread)),
            measure,
            rnd.gauss(100, 30),
        )
        for measure, n in counts.items()
        for _ in range(n)
    ]


def expected(rows):
    def values(kind):
        return [r for r in rows if r[4] == kind and r[5] is not None]

    def amplitude(kind):
        days = np.array([r[3].timetuple().tm_yday for r in values(kind)]) / 365 * 2 * np.pi
        x = np.column_stack([np.ones(len(days)), np.sin(days), np.cos(days)])
        fit = np.linalg.lstsq(x, np.array([r[5] for r in values(kind)]), rcond=None)[0]
        return float(np.hypot(fit[1], fit[2]))

    lat, lon = [r[1] for r in rows], [r[2] for r in rows]
    hi, lo, wet = ([r[5] for r in values(k)] for k in ("TMAX", "TMIN", "PRCP"))
    return [
        rows[0][0], np.mean(lat), np.mean(lon), np.std(lat, ddof=1), np.std(lon, ddof=1),
        np.mean(hi), np.mean(lo), np.std(hi, ddof=1), np.std(lo, ddof=1), np.mean(wet),
        amplitude("TMAX"), amplitude("TMIN"),
    ]


def test_profile_of_each_cluster(spark):
    groups = [
        observations(1, {"TMAX": 25, "TMIN": 20, "PRCP": 3, "SNOW": 40}, seed=1),
        # A third of all rows and more are of one cluster.
        observations(2, {"TMAX": 300, "TMIN": 200, "PRCP": 100}, seed=2),
    ]
    rows = [r for g in groups for r in g]
    found = P.climate_profile(spark.createDataFrame(rows, SCHEMA).repartition(6))
    assert found.dtypes == [(f.name, f.dataType.simpleString()) for f in CLUSTER_PROFILE]
    profiles = sorted(tuple(r) for r in found.collect())
    assert len(profiles) == 2
    for profile, group in zip(profiles, groups):
        assert profile == pytest.approx(expected(group), rel=1e-8)


@pytest.mark.parametrize(
    "counts, kept",
    [
        ({"TMAX": 20, "TMIN": 20, "PRCP": 3}, True),
        ({"TMAX": 19, "TMIN": 20, "PRCP": 3}, False),
        ({"TMAX": 20, "TMIN": 19, "PRCP": 3}, False),
        ({"TMAX": 20, "TMIN": 20, "PRCP": 2}, False),
        ({"TMAX": 200}, False),
    ],
)
def test_guard(spark, counts, kept):
    df = spark.createDataFrame(observations(1, counts), SCHEMA)
    assert P.climate_profile(df).count() == kept


def test_guard_counts_rows_without_values(spark):
    rows = observations(1, {"TMAX": 20, "TMIN": 20, "PRCP": 3})
    rows = [(*r[:5], None) if i < 5 else r for i, r in enumerate(rows)]
    (found,) = P.climate_profile(spark.createDataFrame(rows, SCHEMA)).collect()
    assert tuple(found) == pytest.approx(expected(rows), rel=1e-8)


def test_one_day_has_no_seasonal_variation(spark):
    rows = observations(1, {"TMAX": 30, "TMIN": 30, "PRCP": 3}, spread=0)
    (found,) = P.climate_profile(spark.createDataFrame(rows, SCHEMA)).collect()
    assert (found.tmax_seasonal_var, found.tmin_seasonal_var) == (None, None)
    assert found.tmax is not None


def test_stations_to_profile(spark):
    rnd = random.Random(7)
    places = [(0.0, 0.0), (40.0, 0.0), (0.0, 40.0)]
    stations = [
        (f"S{i}", places[i % 3][0] + rnd.random(), places[i % 3][1] + rnd.random())
        for i in range(30)
    ]
    station_table = spark.createDataFrame(stations, "sid string, lat double, lon double")
    rows = []
    for sid, *_ in stations:
        for r in observations(0, {"TMAX": 3, "TMIN": 3, "PRCP": 1}, seed=sid):
            rows.append((sid, *r[3:]))
    data = spark.createDataFrame(rows, "sid string, date date, measure string, value double")
    clustered = P.cluster_stations(station_table, k=3, seed=1)
    assert clustered.columns == ["sid", "lat", "lon", "cluster"]
    assert clustered.filter(~F.col("cluster").between(0, 2)).count() == 0
    for limit in (0, 1 << 20):
        found = P.station_cluster_profile(data, station_table, k=3, max_broadcast_bytes=limit)
        assert sorted(round(r.lat + r.lon, -1) for r in found.collect()) == [0.0, 40.0, 40.0]
        assert found.dtypes == [(f.name, f.dataType.simpleString()) for f in CLUSTER_PROFILE]


def test_clusters_are_merged_from_their_moments(spark):
    """Any clusters, put together, have the profile of all rows; some rows lack a value or a date."""
    rows = []
    for cluster in range(12):
        rows += observations(cluster, {"TMAX": 9 + cluster, "TMIN": 7, "PRCP": cluster % 3, "SNOW": 2}, seed=cluster)
    rows = [(*r[:5], None) if i % 17 == 0 else r for i, r in enumerate(rows)]
    whole = [(0, *r[1:]) for r in rows]
    parts = P.cluster_moments(spark.createDataFrame(rows, SCHEMA).repartition(5))
    (found,) = P.profile_of_moments(P.merge_clusters(parts)).collect()
    assert found.observations == len(rows)
    assert tuple(found)[1:] == pytest.approx(expected(whole)[1:], rel=1e-8)
    by = parts.withColumn("half", F.col("num") % 2)
    halves = P.profile_of_moments(P.merge_clusters(by, ["half"])).collect()
    for half in halves:
        own = [(0, *r[1:]) for r in rows if r[0] % 2 == half.half]
        assert tuple(half)[2:] == pytest.approx(expected(own)[1:], rel=1e-8)
    assert len(halves) == 2


def test_profile_of_moments_is_the_profile(spark):
    rows = observations(1, {"TMAX": 25, "TMIN": 20, "PRCP": 3}) + observations(2, {"TMAX": 25, "TMIN": 19, "PRCP": 3})
    df = spark.createDataFrame(rows, SCHEMA)
    found = P.profile_of_moments(P.cluster_moments(df)).drop("observations").collect()
    (want,) = P.climate_profile(df).collect()
    assert [tuple(r) for r in found] == [pytest.approx(tuple(want), rel=1e-9)]


def test_moments_of_nothing(spark):
    df = spark.createDataFrame([], SCHEMA)
    (row,) = P.merge_clusters(P.cluster_moments(df)).collect()
    assert (row.tmax.n, row.tmax.m0, row.tmax.c00) == (0.0, None, None)
    assert P.profile_of_moments(P.merge_clusters(P.cluster_moments(df))).collect() == []
    same = observations(1, {"TMAX": 30, "TMIN": 30, "PRCP": 3}, spread=0)
    (flat,) = P.profile_of_moments(P.cluster_moments(spark.createDataFrame(same, SCHEMA))).collect()
    assert flat.tmax_seasonal_var is None and flat.tmaxstd is not None


def test_the_model_is_applied_once(spark):
    """The clustered stations are written once and read by the join."""
    stations = spark.createDataFrame([(f"S{i}", float(i), 1.0) for i in range(9)], "sid string, lat double, lon double")
    data = spark.createDataFrame([("S1", dt.date(2017, 1, 1), "TMAX", 1.0)], "sid string, date date, measure string, value double")
    joined = P.station_observations(data, stations, k=2)
    text = plan(joined, "formatted")
    assert "UDF" not in text and text.count("/dimension") == 1
    assert joined.count() == 1
