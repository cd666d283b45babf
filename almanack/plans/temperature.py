"""Mean temperature per station, from daily maxima and minima.

The mean is over all pairs of a maximum and a minimum of one station and day.
A station and day with n maxima and m minima makes n·m pairs, so a repeated
key would blow a join up. The mean needs only sums and counts of each kind:
the n·m pairs add up to ``m·sum(tmax) + n·sum(tmin)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from almanack.functions import mean_fahrenheit
from almanack.operators.ranking import first_rows

TMAX, TMIN = "TMAX", "TMIN"


def _first(measurements: DataFrame, limit: int | None) -> DataFrame:
    """The first so many maxima and so many minima."""
    if limit is None:
        return measurements
    kinds = [measurements.filter(F.col("measure") == kind) for kind in (TMAX, TMIN)]
    first = [first_rows(rows, limit, "sid", "date", "value") for rows in kinds]
    return first[0].unionByName(first[1])


def station_temperature(
    measurements: DataFrame, stations: DataFrame, limit: int | None = None
) -> DataFrame:
    """``sid, tave`` with the station's columns, in Fahrenheit.

    ``limit`` keeps only the first so many maxima and so many minima, in order
    of station, date and value. They are selected by rank, not by a top-n.
    """
    data = _first(measurements, limit).filter(F.col("measure").isin(TMAX, TMIN))

    def of(kind: str, value: Column) -> Column:
        return F.when(F.col("measure") == kind, value)

    value, one = F.col("value"), F.lit(1)
    days = data.groupBy("sid", "date").agg(
        F.count(of(TMAX, one)).cast("double").alias("max_rows"),
        F.count(of(TMIN, one)).cast("double").alias("min_rows"),
        F.count(of(TMAX, value)).cast("double").alias("max_n"),
        F.count(of(TMIN, value)).cast("double").alias("min_n"),
        F.sum(of(TMAX, value)).alias("max_sum"),
        F.sum(of(TMIN, value)).alias("min_sum"),
    )
    # A pair with a NULL value makes no mean, but its station stays in the result.
    paired = days.filter((F.col("max_rows") > 0) & (F.col("min_rows") > 0))
    pairs = F.sum(F.col("max_n") * F.col("min_n"))
    mean_max = F.sum(F.col("max_sum") * F.col("min_n")) / F.nullif(pairs, F.lit(0.0))
    mean_min = F.sum(F.col("min_sum") * F.col("max_n")) / F.nullif(pairs, F.lit(0.0))
    means = paired.groupBy("sid").agg(mean_fahrenheit(mean_max, mean_min).alias("tave"))
    return means.join(stations, "sid")


def station_temperature_sql(
    spark: SparkSession,
    measurements: DataFrame,
    stations: DataFrame,
    limit: int | None = None,
) -> DataFrame:
    """The same result from SQL text: maxima joined with minima, then stations."""
    _first(measurements, limit).createOrReplaceTempView("almanack_measurements")
    stations.createOrReplaceTempView("almanack_stations")
    return spark.sql("""
        SELECT * FROM
          (SELECT sid,
                  (sum(max_sum * min_n) + sum(min_sum * max_n)) / nullif(sum(max_n * min_n), 0)
                    / 20 * 1.8 + 32 AS tave
           FROM
             (SELECT sid, date, CAST(count(value) AS DOUBLE) AS max_n, sum(value) AS max_sum
              FROM (SELECT * FROM almanack_measurements WHERE measure = 'TMAX')
              GROUP BY sid, date)
             JOIN
             (SELECT sid, date, CAST(count(value) AS DOUBLE) AS min_n, sum(value) AS min_sum
              FROM (SELECT * FROM almanack_measurements WHERE measure = 'TMIN')
              GROUP BY sid, date)
             USING (sid, date)
           GROUP BY sid)
        JOIN almanack_stations USING (sid)
    """)
