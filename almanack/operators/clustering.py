"""Feature vectors, k-means and nearest centers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import isqrt, sqrt

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanack.operators.joins import BROADCAST_BYTES, stored_dimension
from almanack.session import stored

#: Distances of rows from centers that a task computes in an iteration of a fit, or to assign clusters.
FIT_DISTANCES = 50_000_000
#: Of more tasks than this, only the square of their number grows with the distances.
FIT_TASKS = 64
#: Centers that reach the tasks in one array.
BLOCK_CENTERS = 10_000
#: Up to so many centers, each point is compared with all of them.
SCAN_CENTERS = 500
#: The grid has a cell for so many centers on average.
CENTERS_PER_CELL = 2
#: So many levels above a cell, at most, is the nearest cell with a center that it is listed for.
NEAR_LEVELS = 2
#: The search for the center nearest to a far point goes down so many levels at a time.
DESCENT_LEVELS = 2
#: A cell with the box and the deputy of its centers, in bytes.
CELL_BYTES = 128
#: Cells count as larger by this part of their width, for what rounding may move.
SLACK = 1e-6


def assemble(df: DataFrame, columns: Sequence[str], output: str) -> DataFrame:
    """Add a vector column made of the numeric columns."""
    return VectorAssembler(inputCols=list(columns), outputCol=output).transform(df)


def fit_kmeans(
    points: DataFrame, columns: Sequence[str], k: int, seed: int, output: str = "cluster"
) -> KMeansModel:
    """Fit k-means on the columns; ``assign_kmeans`` assigns.

    Points at one place are few rows that weigh as many, so means and the sum of squares are those
    of all points. Spark samples the starting centers from rows whatever they weigh; hence a place that has
    more than the mean number of points is as many rows as it has that number, which at most doubles the
    rows. These are dealt by value and sorted, to as many partitions as their number times ``k``
    asks for: the seed makes a run repeatable however the points are partitioned, but for
    rounding, and a small file of many points is no single task. Each iteration shuffles the sums of
    clusters from all these partitions to as many.
    """
    places = stored(points.groupBy(*columns).agg(F.count("*").alias("_points")), "places")
    whole = places.agg(F.count("*").alias("n"), F.coalesce(F.sum("_points"), F.lit(0)).alias("points")).first()
    rows = F.ceil(F.col("_points") * (whole["n"] / max(1, whole["points"])))
    dealt = places.withColumn("_rows", rows).withColumn("_row", F.explode(F.sequence(F.lit(1), "_rows")))
    dealt = dealt.withColumn("_weight", F.col("_points") / F.col("_rows"))
    dealt = dealt.repartition(_tasks(2 * whole["n"] * k), *columns, "_row").sortWithinPartitions(*columns, "_row")
    means = KMeans(k=k, seed=seed, featuresCol="features", predictionCol=output, weightCol="_weight")
    return means.fit(assemble(dealt, columns, "features"))


def assign_kmeans(points: DataFrame, columns: Sequence[str], model: KMeansModel) -> DataFrame:
    """Add the cluster of each point, in the column that the model was fitted for.

    A point is compared with all centers, so a small file of many points is much work. The points are
    counted by partition: where one has more than twice the share that a task would have if
    their number times the centers were dealt evenly, they are dealt out in turn.
    """
    own = points.groupBy(F.spark_partition_id().alias("part")).agg(F.count("*").alias("rows"))
    sums = (F.coalesce(f("rows"), F.lit(0)).alias(f.__name__) for f in (F.sum, F.max))
    rows, largest = own.agg(*sums).first()
    tasks = _tasks(rows * len(model.clusterCenters()))
    dealt = points.repartition(tasks) if largest * tasks > 2 * rows else points
    return model.transform(assemble(dealt, columns, "features")).drop("features")


def _tasks(distances: int) -> int:
    """How many tasks are to compute so many distances."""
    tasks = max(1, -(-distances // FIT_DISTANCES))
    return tasks if tasks <= FIT_TASKS else isqrt(FIT_TASKS * tasks)


def nearest_center(
    points: DataFrame,
    centers: DataFrame,
    columns: Sequence[str],
    center: str = "cluster",
    block_centers: int = BLOCK_CENTERS,
    scan_centers: int = SCAN_CENTERS,
    max_broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add the nearest center's number (the smaller on a tie) to each point.

    ``centers`` has the number in column ``center`` and the same coordinate
    columns as the points. A center that is nowhere (a coordinate is NULL, NaN or
    infinite) is left out; a point that is nowhere gets NULL. Of centers at one
    place only the smallest number can be found, so the others are left out at first.

    Few centers, or those of more than two coordinates, reach the tasks in
    arrays of about ``block_centers``, and a point is compared with all. Of many
    centers in a plane or on a line, a grid is laid over them, and each cell has the list of
    centers that are nearest to some place in it: a point looks up its cell and
    compares a few. For places of points that are far from all centers, by the measure of the
    grid, the nearest center is looked for down the levels of the grid, and joins
    them by place. Either way a point never becomes several rows.
    """
    xs = [f"x{i}" for i in range(len(columns))]
    places = [F.col(c).cast("double").alias(x) for c, x in zip(columns, xs, strict=True)]
    known = centers.select(F.col(center).alias("number"), *places).where(_somewhere(xs))
    known = known.groupBy(*xs).agg(F.min("number").alias("number")).select("number", *xs)
    known = stored(known, "centers")
    ends = [f(x).alias(f"{f.__name__}_{x}") for f in (F.min, F.max) for x in xs[:2]]
    extent = known.agg(F.count("*").alias("n"), *ends).first()
    place = [F.col(c).cast("double") for c in columns]
    if extent["n"] <= scan_centers or len(columns) > 2:
        best = _nearest_of_all(points, known, place, max(1, -(-extent["n"] // block_centers)))
    else:
        best = _nearest_by_cell(points, known, place, _Grid(extent, xs), max_broadcast_bytes)
    found = F.when(_somewhere(columns), F.col("_best")["number"])
    return best.withColumn(center, found).select(*points.columns, center)


def _somewhere(columns: Sequence[str]) -> Column:
    sizes = [F.abs(F.col(c).cast("double")) for c in columns]
    # NaN is above infinity.
    return reduce(Column.__and__, [F.coalesce(s < float("inf"), F.lit(False)) for s in sizes])


def _squared(place: Sequence[Column], c: Column) -> Column:
    return reduce(Column.__add__, [(x - c[f"x{i}"]) * (x - c[f"x{i}"]) for i, x in enumerate(place)])


def _first_nearest(array: Column, place: Sequence[Column]) -> Column:
    """(distance, number) of the nearest in an array, of equally near ones the smaller number."""
    ranked = F.transform(
        array, lambda c: F.struct(_squared(place, c).alias("distance"), c["number"].alias("number"))
    )
    return F.array_min(ranked)


def _nearest_of_all(
    points: DataFrame, known: DataFrame, place: Sequence[Column], blocks: int
) -> DataFrame:
    packed = F.struct(*known.columns)
    found = points.withColumn("_best", F.lit(None))
    for block in range(blocks):
        own = known.where(F.pmod(F.xxhash64("number"), F.lit(blocks)) == block)
        # Spark takes no subquery inside a higher-order function, hence the column.
        found = found.withColumn("_centers", own.agg(F.collect_list(packed)).scalar())
        nearest = _first_nearest(F.col("_centers"), place)
        # least() passes over NULL: a block without centers.
        best = nearest if block == 0 else F.least("_best", nearest)
        found = found.withColumn("_best", best).drop("_centers")
    return found


class _Grid:
    """Square cells over the box of the centers, and coarser levels: four cells make one above."""

    def __init__(self, extent, xs: Sequence[str]):
        self.low = [extent[f"min_{x}"] for x in xs] + [0.0] * (2 - len(xs))
        high = [extent[f"max_{x}"] for x in xs] + [0.0] * (2 - len(xs))
        spans = [b - a for a, b in zip(self.low, high, strict=True)]
        cells = max(1, extent["n"] // CENTERS_PER_CELL)
        self.width = max(sqrt(spans[0] * spans[1] / cells), max(spans) / cells) or 1.0
        self.sides = [int(span / self.width) + 1 for span in spans]

    def cell(self, place: Sequence[Column]) -> list[Column]:
        both = [*place, F.lit(0.0)][:2]
        return [F.floor((x - low) / self.width) for x, low in zip(both, self.low, strict=True)]

    def corners(self) -> list[tuple[Column, Column]]:
        """Of the cell (i, j), made a little larger."""

        def edge(name: str, low: float, more: float) -> Column:
            return F.lit(low) + (F.col(name) + more) * self.width

        ends = (-SLACK, 1 + SLACK)
        return [(edge("i", self.low[0], a), edge("j", self.low[1], b)) for a in ends for b in ends]


def _above(name: str, level: str = "level") -> Column:
    """The number of the cell so many levels up that a cell is in."""
    return F.call_function("shiftright", F.col(name), F.col(level))


def _nearest_by_cell(
    points: DataFrame, known: DataFrame, place: Sequence[Column], grid: _Grid, max_broadcast_bytes: int
) -> DataFrame:
    # A center in a list is a number and two coordinates.
    size = F.coalesce(F.sum(F.size("near") * 32 + 64), F.lit(0))
    cells = stored_dimension(_cell_table(known, grid), max_broadcast_bytes, size)
    cells = cells.select(F.col("i").alias("_i"), F.col("j").alias("_j"), F.col("near").alias("_near"))
    column, row = grid.cell(place)
    own = {f"_p{i}": x for i, x in enumerate(place)}
    found = points.withColumns({"_i": column, "_j": row, **own})

    far = found.where(_somewhere(list(own))).select("_i", "_j", *own)
    far = far.join(cells.select("_i", "_j"), ["_i", "_j"], "left_anti").select(*own).distinct()
    nearest = _nearest_by_descent(stored(far, "far"), known, grid, max_broadcast_bytes)
    nearest = stored_dimension(nearest, max_broadcast_bytes)
    found = found.join(cells, ["_i", "_j"], "left").join(nearest, list(own), "left")
    near = F.when(F.col("_near").isNotNull(), _first_nearest(F.col("_near"), place))
    return found.withColumn("_best", near.otherwise(F.col("_far")))


def _nearest_by_descent(
    far: DataFrame, known: DataFrame, grid: _Grid, max_broadcast_bytes: int
) -> DataFrame:
    """Add (distance, number) of the nearest center as ``_far`` to each of the places ``_p0`` ….

    A place begins in the one cell that has all centers. On each level it has a bound, its least
    distance from a deputy, and goes on into the cells whose centers' box is not
    farther than that. A box is never farther than a center in it, in rounded numbers too:
    what is lost is farther than the bound.
    """
    own = far.columns
    place = [F.col(c) for c in own]
    xs = [c for c in known.columns if c != "number"]
    column, row = grid.cell([F.col(x) for x in xs])
    centers = known.select(F.struct(*known.columns).alias("center"), column.alias("i"), row.alias("j"))
    level = max(side.bit_length() for side in grid.sides)
    reached = far.select(*own, F.lit(0).cast("long").alias("ci"), F.lit(0).cast("long").alias("cj"))
    anywhere = not far.isEmpty()
    while level and anywhere:
        below = max(0, level - DESCENT_LEVELS)
        ends = [f(f"center.{x}").alias(f"{f.__name__}_{x}") for x in xs for f in (F.min, F.max)]
        at = [F.shiftright(F.col(c), below).alias(f"b{c}") for c in ("i", "j")]
        cells = centers.groupBy(*at).agg(F.min("center").alias("deputy"), *ends)
        up = [F.shiftright(F.col(f"b{c}"), level - below).alias(f"c{c}") for c in ("i", "j")]
        cells = cells.select("*", *up)
        most = CELL_BYTES
        for side in grid.sides:
            most *= (side >> below) + 1
        if most <= max_broadcast_bytes:
            cells = F.broadcast(cells)
        outside = [
            F.greatest(F.col(f"min_{x}") - p, p - F.col(f"max_{x}"), F.lit(0.0))
            for p, x in zip(place, xs, strict=True)
        ]
        met = reached.join(cells, ["ci", "cj"]).select(
            *own,
            F.col("bi").alias("ci"),
            F.col("bj").alias("cj"),
            reduce(Column.__add__, [d * d for d in outside]).alias("box"),
            _squared(place, F.col("deputy")).alias("deputy"),
        )
        met = stored(met, "descent")
        bounds = met.groupBy(*own).agg(F.min("deputy").alias("bound"))
        reached = met.join(bounds, own).where("box <= bound").select(*own, "ci", "cj")
        level = below
    centers = centers.select("center", F.col("i").alias("ci"), F.col("j").alias("cj"))
    distance = _squared(place, F.col("center")).alias("distance")
    best = F.min(F.struct(distance, F.col("center.number").alias("number")))
    return reached.join(centers, ["ci", "cj"]).groupBy(*own).agg(best.alias("_far"))


def _cell_table(known: DataFrame, grid: _Grid) -> DataFrame:
    """For each cell the centers that are nearest to some place in it, as an array ``near``.

    Cells are those that lie with a center in one cell ``NEAR_LEVELS`` up.

    1. A cell has a deputy: a center of the smallest cell above it (or itself) that has any.
    2. No place in the cell is farther from its deputy than its farthest corner is. So its
       centers lie in the nine cells around it on the level whose cells are that wide.
    3. Of these stay the ones that some corner is not farther from than from the deputy. What
       is nearer than the deputy to a place in the cell is nearer to a corner too, as
       the difference of the squared distances is linear.
    """
    place = [F.col(x) for x in known.columns if x != "number"]
    column, row = grid.cell(place)
    levels = F.explode(F.sequence(F.lit(0), F.lit(NEAR_LEVELS + 1))).alias("level")
    above = [_above("i").alias("ci"), _above("j").alias("cj")]
    center = F.struct(*known.columns).alias("center")
    held = known.select(center, column.alias("i"), row.alias("j"), levels).select("center", "level", *above)
    deputies = held.groupBy("level", "ci", "cj").agg(F.min("center").alias("deputy"))

    side = 1 << NEAR_LEVELS
    steps = F.sequence(F.lit(0), F.lit(side - 1))
    cells = deputies.where(F.col("level") == NEAR_LEVELS).select(
        (F.col("ci") * side).alias("i0"), (F.col("cj") * side).alias("j0"), F.explode(steps).alias("a")
    )
    cells = cells.select("*", F.explode(steps).alias("b")).select(
        (F.col("i0") + F.col("a")).alias("i"), (F.col("j0") + F.col("b")).alias("j"), levels
    )
    cells = cells.select("*", *above).join(deputies, ["level", "ci", "cj"])
    nearest = F.min(F.struct("level", "deputy")).alias("best")
    cells = cells.groupBy("i", "j").agg(nearest).select("i", "j", "best.deputy")

    def apart(corner: tuple[Column, Column], name: str) -> Column:
        return _squared(corner[: len(place)], F.col(name))

    reach = F.sqrt(F.greatest(*(apart(c, "deputy") for c in grid.corners()))) / grid.width
    # At most NEAR_LEVELS + 1: the deputy is no farther than a diagonal of its cell.
    wide = F.ceil(F.log2(F.greatest(reach, F.lit(1.0)))).cast("int")
    cells = cells.withColumn("level", wide)
    steps = F.sequence(F.lit(-1), F.lit(1))
    around = cells.select("*", F.explode(steps).alias("di")).select("*", F.explode(steps).alias("dj"))
    around = around.withColumn("ci", _above("i") + F.col("di")).withColumn("cj", _above("j") + F.col("dj"))
    pairs = around.join(held, ["level", "ci", "cj"])
    # Equal but for rounding is near enough to stay.
    near = [apart(c, "center") <= apart(c, "deputy") * (1 + SLACK) for c in grid.corners()]
    listed = pairs.where(reduce(Column.__or__, near)).groupBy("i", "j")
    return listed.agg(F.collect_list("center").alias("near"))
