import datetime as dt
import random

import numpy as np
import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from almanack import operators as O
from almanack import plans as P
from plans_text import plan


def test_assemble(spark):
    df = spark.createDataFrame([(1.5, 2)], "a double, b int")
    row = O.assemble(df, ["b", "a"], "v").select(vector_to_array("v").alias("v")).first()
    assert row.v == [2.0, 1.5]


@pytest.fixture(scope="module")
def blobs(spark):
    rnd = random.Random(2)
    middles = [(0, 0), (0, 50), (50, 0), (50, 50)]
    points = [
        (i, m[0] + rnd.uniform(-1, 1), m[1] + rnd.uniform(-1, 1))
        for i, m in enumerate(middles * 25)
    ]
    return spark.createDataFrame(points, "n int, lat double, lon double")


def test_kmeans_finds_separate_groups(blobs):
    model = O.fit_kmeans(blobs, ["lat", "lon"], k=4, seed=3)
    found = model.transform(O.assemble(blobs, ["lat", "lon"], "features")).collect()
    clusters = {i: {r.cluster for r in found if r.n % 4 == i} for i in range(4)}
    assert all(len(c) == 1 for c in clusters.values())
    assert set.union(*clusters.values()) == {0, 1, 2, 3}


def test_kmeans_points_are_with_their_nearest_center(spark, blobs):
    model = O.fit_kmeans(blobs, ["lat", "lon"], k=7, seed=3)
    assigned = model.transform(O.assemble(blobs, ["lat", "lon"], "features"))
    centers = spark.createDataFrame(
        [(i, float(c[0]), float(c[1])) for i, c in enumerate(model.clusterCenters())],
        "cluster int, lat double, lon double",
    )
    again = O.nearest_center(blobs, centers, ["lat", "lon"])
    both = assigned.select("n", F.col("cluster").alias("c")).join(again, "n")
    assert both.filter("c <> cluster").count() == 0


@pytest.fixture
def fitted_rows(monkeypatch):
    """The tables that k-means is fitted on."""
    tables, fit = [], O.clustering.KMeans.fit
    monkeypatch.setattr(O.clustering.KMeans, "fit", lambda self, df: tables.append(df) or fit(self, df))
    return tables


def test_kmeans_work_is_that_of_the_places(spark, fitted_rows):
    """Copies of points add no rows to the fit; the centers are the means of all copies."""
    rnd = random.Random(5)
    places = [(i // 30 * 50 + rnd.random(), i % 30 / 30) for i in range(60)]
    for copies in (1, 40):
        points = [(*p, i % 7) for i, p in enumerate(places) for _ in range(copies)]
        df = spark.createDataFrame(points, "x double, y double, other int").repartition(5)
        centers = sorted(tuple(c) for c in O.fit_kmeans(df, ["x", "y"], k=2, seed=1).clusterCenters())
        assert centers == [pytest.approx(np.mean(own, axis=0)) for own in (places[:30], places[30:])]
    assert [df.count() for df in fitted_rows] == [60, 60]


def test_kmeans_weighs_places_by_their_points(spark, fitted_rows):
    """A place with most of the points is more rows, fewer than two for a place in all."""
    rnd = random.Random(8)
    places = [(1000.0 * (i % 2) + rnd.random() * 3, 4.0 if i == 7 else rnd.random()) for i in range(50)]
    points = [p for i, p in enumerate(places) for _ in range(5_000 if i == 7 else 1 + i % 3)]
    model = O.fit_kmeans(spark.createDataFrame(points, "x double, y double"), ["x", "y"], k=2, seed=1)
    wanted = [np.mean([p for p in points if (p[0] > 500) == high], axis=0) for high in (False, True)]
    assert sorted(tuple(c) for c in model.clusterCenters()) == [pytest.approx(w) for w in wanted]
    (rows,) = fitted_rows
    assert 80 < rows.count() <= 100
    assert rows.agg(F.sum("_weight")).first()[0] == pytest.approx(len(points))


def test_kmeans_is_the_same_on_any_partitions(spark, monkeypatch, fitted_rows):
    monkeypatch.setattr(O.clustering, "FIT_DISTANCES", 1_000)
    rnd = random.Random(1)
    df = spark.createDataFrame([(rnd.random(), rnd.random()) for _ in range(200)], "x double, y double")
    found = []
    for n in (1, 6):
        model = O.fit_kmeans(df.repartition(n), ["x", "y"], k=12, seed=4)
        found.append([pytest.approx(tuple(c)) for c in model.clusterCenters()])
    assert found[0] == [c.expected for c in found[1]]
    assert [t.rdd.getNumPartitions() for t in fitted_rows] == [5, 5]


@pytest.mark.parametrize("rows, tasks", [(100, 6), (400, 12)])
def test_kmeans_shuffles_grow_with_the_rows(spark, monkeypatch, fitted_rows, rows, tasks):
    """An iteration shuffles from all partitions to as many: beyond FIT_TASKS, only their square grows."""
    monkeypatch.setattr(O.clustering, "FIT_DISTANCES", 100)
    monkeypatch.setattr(O.clustering, "FIT_TASKS", 4, raising=False)
    rnd = random.Random(7)
    df = spark.createDataFrame([(rnd.random(), rnd.random()) for _ in range(rows)], "x double, y double")
    O.fit_kmeans(df, ["x", "y"], k=5, seed=4)
    assert [t.rdd.getNumPartitions() for t in fitted_rows] == [tasks]


def sizes_of(df):
    return sorted(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())


def test_stations_of_one_partition_are_assigned_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(O.clustering, "FIT_DISTANCES", 1_000)
    rnd = random.Random(3)
    rows = [(f"s{i}", rnd.random(), rnd.random()) for i in range(500)]
    rows += [("copy", 0.5, 0.5)] * 250  # a third of the rows are the same
    df = spark.createDataFrame(rows, "sid string, lat double, lon double").coalesce(1)
    found = P.cluster_stations(df, k=12)
    assert found.columns == ["sid", "lat", "lon", "cluster"]
    sizes = sizes_of(found)
    assert sum(sizes) == 750 and len(sizes) == 9 and sizes[-1] <= 750 / 9 * 1.5
    model = O.fit_kmeans(df, ["lat", "lon"], k=12, seed=1)
    wanted = model.transform(O.assemble(df, ["lat", "lon"], "features")).drop("features")
    got = O.assign_kmeans(df, ["lat", "lon"], model)
    assert sorted(got.collect()) == sorted(wanted.collect())


def test_points_of_even_partitions_stay_where_they_are(spark, monkeypatch, blobs):
    model = O.fit_kmeans(blobs, ["lat", "lon"], k=4, seed=3)
    assert "Exchange" not in plan(O.assign_kmeans(blobs.coalesce(1), ["lat", "lon"], model))
    monkeypatch.setattr(O.clustering, "FIT_DISTANCES", 100)
    spread = spark.range(0, 100, 1, 8).select(F.col("id").alias("lat"), F.lit(2.0).alias("lon"))
    assert "Exchange" not in plan(O.assign_kmeans(spread, ["lat", "lon"], model))
    assert O.assign_kmeans(blobs.limit(0), ["lat", "lon"], model).collect() == []


def test_nearest_center_like_brute_force(spark):
    rnd = random.Random(4)
    points = [(i, rnd.randint(0, 9), rnd.random()) for i in range(200)]
    centers = [(10 - i, float(rnd.randint(0, 9)), rnd.random()) for i in range(10)]
    found = O.nearest_center(
        spark.createDataFrame(points, "n int, x int, y double"),
        spark.createDataFrame(centers, "cluster int, x double, y double"),
        ["x", "y"],
    )
    assert found.columns == ["n", "x", "y", "cluster"]
    wanted = {
        n: min(((x - a) ** 2 + (y - b) ** 2, c) for c, a, b in centers)[1] for n, x, y in points
    }
    assert {r.n: r.cluster for r in found.collect()} == wanted


def test_nearest_center_takes_the_smaller_number_on_a_tie(spark):
    points = spark.createDataFrame([(0.0,)], "x double")
    centers = spark.createDataFrame([(5, 1.0), (2, -1.0), (9, 1.0)], "cluster int, x double")
    assert O.nearest_center(points, centers, ["x"]).first().cluster == 2


def test_nearest_center_pairs_no_rows(spark):
    points = spark.range(5).select(F.col("id").cast("double").alias("x"))
    centers = points.select("x", F.monotonically_increasing_id().alias("cluster"))
    found = O.nearest_center(points, centers, ["x"], block_centers=2)
    assert "Join" not in plan(found) and "Product" not in plan(found)


def test_nearest_of_many_centers(spark):
    """More centers than one array takes."""
    n = 12_000
    centers = spark.range(n).select(
        F.col("id").cast("int").alias("cluster"), (F.col("id") * 7919 % n / 3).alias("x")
    )
    points = spark.range(40).select((F.col("id") * 97.3).alias("x"))
    places = np.array([i * 7919 % n / 3 for i in range(n)])
    wanted = {x: int(np.argmin((places - x) ** 2)) for x in (i * 97.3 for i in range(40))}
    for block in (10_000, 1_700):
        found = O.nearest_center(points, centers, ["x"], block_centers=block).collect()
        assert {r.x: r.cluster for r in found} == wanted


@pytest.mark.parametrize("block", [1, 10])
def test_nearest_center_of_no_place_is_null(spark, block):
    rows = [(1, 1.0), (2, float("nan")), (3, None)]
    points = spark.createDataFrame(rows, "n int, x double")
    centers = spark.createDataFrame([(7, 0.0), (8, 3.0), (9, float("nan"))], "cluster int, x double")
    found = O.nearest_center(points, centers, ["x"], block_centers=block).collect()
    assert {r.n: r.cluster for r in found} == {1: 7, 2: None, 3: None}
    assert O.nearest_center(points, centers.limit(0), ["x"]).first().cluster is None


def nearest_by_force(points, centers):
    """The nearest center of each place, in the order of number on a tie."""
    numbers = np.array([c[0] for c in centers])
    places = np.array([c[1:] for c in centers])
    order = np.argsort(numbers, kind="stable")
    numbers, places = numbers[order], places[order]
    out = []
    for p in points:
        squares = [(p[k] - places[:, k]) * (p[k] - places[:, k]) for k in range(len(p))]
        out.append(int(numbers[np.argmin(sum(squares[1:], squares[0]))]))
    return out


SHAPES = {
    "uniform": lambda r: (r.random() * 10, r.random() * 3),
    "lattice, with ties": lambda r: (float(r.randint(0, 12)), float(r.randint(0, 12))),
    "clumps and a hole": lambda r: (r.choice([0.0, 100.0]) + r.random() ** 3, r.choice([0.0, 7.0]) + r.random()),
    "on a line": lambda r: (r.random() * 50, 4.0),
    "on a slope": lambda r: (x := r.random() * 50, 2 * x),
    "one place": lambda r: (1.0, 2.0),
    "far outlier": lambda r: (r.random(), 1e6 if r.random() < 0.01 else r.random()),
}


@pytest.mark.parametrize("shape", SHAPES)
@pytest.mark.parametrize("limit", [0, 1 << 26])
def test_nearest_center_by_cells_like_brute_force(spark, shape, limit):
    rnd = random.Random(11)
    centers = [(1000 - i, *SHAPES[shape](rnd)) for i in range(300)]
    points = [SHAPES[shape](rnd) for _ in range(250)]
    points += [(x + rnd.gauss(0, 1), y + rnd.gauss(0, 1)) for x, y in points[:100]]
    points += [(c[1], c[2]) for c in centers[:50]] + [(-1e9, 3.0), (1e12, 1e12), (0.0, 0.0), (6.0, -300.0)]
    odd = [(None, 1.0), (float("nan"), 1.0), (1.0, float("inf"))]
    nowhere = [(-5, None, 1.0), (-6, 1.0, float("nan")), (-7, float("-inf"), 0.0)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate([*points, *odd])], "n int, x double, y double")
    table = spark.createDataFrame([*centers, *nowhere], "cluster int, x double, y double")
    found = O.nearest_center(df, table, ["x", "y"], scan_centers=10, max_broadcast_bytes=limit)
    assert found.columns == ["n", "x", "y", "cluster"]
    got = {r.n: r.cluster for r in found.collect()}
    wanted = nearest_by_force(points, centers)
    assert [got[i] for i in range(len(points))] == wanted
    assert [got[len(points) + i] for i in range(len(odd))] == [None] * len(odd)
    assert len(got) == len(points) + len(odd)


def test_copies_of_a_center_are_listed_once(spark, monkeypatch):
    """Many centers at one place make neither more cells nor longer lists; the smallest number counts."""
    tables = []

    def stored_dimension(df, *args):
        tables.append(df)
        return df

    monkeypatch.setattr("almanack.operators.clustering.stored_dimension", stored_dimension)
    rnd = random.Random(6)
    places = [(rnd.random() * 9, rnd.random() * 9) for _ in range(60)]
    points = [(rnd.random() * 9, rnd.random() * 9) for _ in range(100)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "n int, x double, y double")
    sizes = []
    for copies in (1, 20):
        centers = [(60 * c + i, *p) for i, p in enumerate(places) for c in reversed(range(copies))]
        table = spark.createDataFrame(centers, "cluster int, x double, y double")
        found = O.nearest_center(df, table, ["x", "y"], scan_centers=10)
        got = {r.n: r.cluster for r in found.collect()}
        assert [got[i] for i in range(len(points))] == nearest_by_force(points, centers)
        cells = next(t for t in tables if "near" in t.columns)
        sizes.append(cells.agg(F.count("*"), F.sum(F.size("near"))).first())
        tables.clear()
    assert sizes[0] == sizes[1]


@pytest.mark.parametrize("limit", [0, 1 << 26])
def test_far_points_meet_no_array_of_all_centers(spark, limit):
    """Half of the points are in the middle of a ring of centers or beyond it; a third at one place."""
    rnd = random.Random(9)
    turns = [2 * np.pi * i / 900 for i in range(900)]
    centers = [(i, float(50 * np.cos(t)), float(50 * np.sin(t))) for i, t in enumerate(turns)]
    points = [(rnd.uniform(-9, 9), rnd.uniform(-9, 9)) for _ in range(60)]
    points += [(rnd.uniform(-400, 400), rnd.uniform(-400, 400)) for _ in range(60)]
    points += [(0.0, 0.0), (-0.0, 3.0)] * 40 + [(1e200, 0.0), (-1e150, 1e150), (50.0, 1e7)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "n int, x double, y double")
    table = spark.createDataFrame(centers, "cluster int, x double, y double")
    found = O.nearest_center(df, table, ["x", "y"], scan_centers=10, max_broadcast_bytes=limit)
    text = plan(found)
    assert "ubquery" not in text and "NestedLoop" not in text and "Product" not in text
    got = {r.n: r.cluster for r in found.collect()}
    assert [got[i] for i in range(len(points))] == nearest_by_force(points, centers)


def test_nearest_of_fifty_thousand_centers(spark):
    """A plan of the size of that for few thousand, and the nearest of each point."""
    rng = np.random.default_rng(5)
    places = rng.normal(0, 20, (50_000, 2))
    points = rng.normal(0, 20, (3_000, 2))
    points[::3] = places[7] + 0.01  # a third of the points are in one cell
    schema = "cluster int, x double, y double"
    rows = [(i, float(x), float(y)) for i, (x, y) in enumerate(places)]
    df = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(points)], "n int, x double, y double")
    found, fewer = (
        O.nearest_center(df, spark.createDataFrame(own, schema), ["x", "y"], max_broadcast_bytes=0)
        for own in (rows, rows[:3_000])
    )
    assert plan(found).count("\n") == plan(fewer).count("\n")
    assert "Product" not in plan(found) and "NestedLoop" not in plan(found)
    got = {r.n: r.cluster for r in found.collect()}
    wanted = nearest_by_force([tuple(p) for p in points], [(i, *p) for i, p in enumerate(places.tolist())])
    assert [got[i] for i in range(len(points))] == wanted


def test_nearest_center_on_a_line_by_cells(spark):
    rnd = random.Random(3)
    centers = [(i, rnd.random() * 100) for i in range(700)]
    points = [(rnd.random() * 120 - 10,) for _ in range(200)]
    found = O.nearest_center(
        spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "n int, x double"),
        spark.createDataFrame(centers, "cluster int, x double"),
        ["x"],
    )
    got = {r.n: r.cluster for r in found.collect()}
    assert [got[i] for i in range(len(points))] == nearest_by_force(points, centers)


def wave(days, shape):
    start = dt.date(2017, 1, 1)
    return [(1, start + dt.timedelta(d), shape(d)) for d in days]


def angle(day):
    return (day + 1) / 365 * 2 * np.pi


SCHEMA = "g int, date date, value double"


def test_amplitude_of_an_exact_wave(spark):
    def shape(d):
        return float(100 + 3 * np.sin(angle(d)) - 4 * np.cos(angle(d)))

    df = spark.createDataFrame(wave(range(0, 365, 7), shape), SCHEMA)
    wave_size = O.seasonal_amplitude(F.col("date"), F.col("value"))
    row = df.groupBy("g").agg(wave_size.alias("a")).first()
    assert row.a == pytest.approx(5.0, abs=1e-9)


def test_fit_agrees_with_linear_regression_in_each_group(spark):
    rnd = random.Random(8)
    rows = [(i % 3, rnd.random(), rnd.random() * (i % 3 + 1), rnd.random()) for i in range(150)]
    rows += [(0, None, 1.0, 5.0), (1, 1.0, None, 5.0), (2, 1.0, 1.0, None)]
    df = spark.createDataFrame(rows, "g int, x1 double, x2 double, y double").repartition(5)
    fit = O.fit_plane(F.col("x1"), F.col("x2"), F.col("y")).alias("fit")
    fits = {r.g: r for r in df.groupBy("g").agg(fit).select("g", "fit.*").collect()}
    vectors = VectorAssembler(inputCols=["x1", "x2"], outputCol="features")
    for g in range(3):
        data = vectors.transform(df.filter(F.col("g") == g).dropna())
        model = LinearRegression(labelCol="y", maxIter=10).fit(data)
        assert fits[g].intercept == pytest.approx(model.intercept, abs=1e-8)
        assert [fits[g].b1, fits[g].b2] == pytest.approx(list(model.coefficients), abs=1e-8)


@pytest.mark.parametrize("days", [[40] * 30, [40, 200] * 15, []])
def test_too_few_distinct_days_give_null(spark, days):
    df = spark.createDataFrame(wave(days, lambda d: float(d % 7)), SCHEMA)
    row = df.agg(O.seasonal_amplitude(F.col("date"), F.col("value")).alias("a")).first()
    assert row.a is None


def test_three_days_in_a_row_are_enough(spark):
    rows = wave([90, 91, 92] * 10, lambda d: float(7 + 2 * np.sin(angle(d))))
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    row = df.agg(O.seasonal_amplitude(F.col("date"), F.col("value")).alias("a")).first()
    assert row.a == pytest.approx(2.0, rel=1e-4)
