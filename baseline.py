"""Time plain forms of the analyses against the library's, and print a table.

A plain form does what a first program for the analysis does: it joins before it
sums, pairs rows by a condition, and asks for one statistic, or one cluster, at a
time. Both forms see the same records of the same tables. The environment is
"""

from __future__ import annotations

import os
import statistics
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almanack.registry import QUERIES
from almanack.registry import standins as st
from almanack.session import local_session


def weekly_consumption(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key is text before the sums, and nothing is said about the sizes of tables."""
    sales, days = st.regional_sales(spark, sf_dir), st.calendar(spark, sf_dir)
    year = (F.col("date_year") % 1000).cast("string")
    key = F.concat(F.lit("Y"), year, F.lit("_W"), F.col("week_number").cast("string"))
    summed = (
        sales.crossJoin(days.withColumnRenamed("date_id", "day"))
        .where("date_id = day")
        .groupBy(key.alias("week"), "store_id", "product_id")
        .agg(F.sum("sales_units").alias("units"), F.round(F.sum("net_sales"), 2).alias("net"))
    )
    joined = summed.join(st.regions(spark, sf_dir), "store_id").join(
        st.product_types(spark, sf_dir), "product_id"
    )
    parts = ["week", "country", "division", "gender", "category"]
    return joined.select(F.concat_ws("_", *parts).alias("id"), "units", "net")


def station_temperature(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maxima joined with minima, pair by pair."""
    data, stations = st.measurements(spark, sf_dir), st.stations(spark, sf_dir)
    high = data.where("measure = 'TMAX'").drop("measure").withColumnRenamed("value", "tmax")
    low = data.where("measure = 'TMIN'").drop("measure").withColumnRenamed("value", "tmin")
    both = high.join(low, ["sid", "date"]).select("sid", F.expr("(tmax + tmin) / 20 * 1.8 + 32 AS t"))
    return both.groupBy("sid").agg(F.avg("t").alias("tave")).join(stations, "sid")


def county_rates_located(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each rate with its title against each county."""
    rates = st.county_rates(spark, sf_dir).withColumn("id", F.trim("id"))
    month = rates.where("id LIKE '%3' AND year = 1997 AND period = 'M10'")
    titled = month.join(st.county_series(spark, sf_dir), F.col("id") == F.col("sid"))
    places = st.zip_codes(spark, sf_dir).where("lat IS NOT NULL").groupBy("county", "state")
    places = places.agg(F.avg("lat").alias("lat"), F.avg("lon").alias("lon"))
    return titled.join(places, F.expr("contains(title, county) AND contains(title, state)"))


def max_decade_by_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The largest mean of each series, joined back to its decade."""
    rates = st.state_rates(spark, sf_dir).where("id LIKE '%03'")
    means = rates.groupBy("id", F.expr("year - year % 10 AS decade")).agg(F.avg("value").alias("mean"))
    best = means.groupBy("id").agg(F.max("mean").alias("mean"))
    best = means.join(best, ["id", "mean"]).groupBy("id", "mean").agg(F.min("decade").alias("decade"))
    titled = best.join(st.state_series(spark, sf_dir).withColumnRenamed("sid", "id"), "id")
    return titled.join(st.areas(spark, sf_dir), F.expr("substring(id, 4, length(id) - 5) = code"))


def daily_statistics_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job for each statistic."""
    days = st.weather_days(spark, sf_dir)
    top = days.agg(F.max("tmax")).first()[0]
    hottest = days.where(F.col("tmax") == top).orderBy("year", "doy").first()
    rainy = days.where("precip >= 1")
    row = (*hottest, rainy.count(), 100 * rainy.count() / days.count(), rainy.agg(F.avg("tmax")).first()[0])
    return spark.createDataFrame([row + tuple(days.agg(F.stddev_pop(c)).first()[0] for c in ("tmax", "tmin", "tave"))])


def cluster_climate_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jobs for each cluster, one cluster after the other."""
    rows = st.order_measurements(spark, sf_dir).join(st.nation_clusters(spark, sf_dir), "sid").cache()
    out = []
    for num in range(25):
        own = rows.where(F.col("cluster") == num)
        kinds = {k: own.where(F.col("measure") == k) for k in ("TMAX", "TMIN", "PRCP")}
        if kinds["TMAX"].count() < 20 or kinds["TMIN"].count() < 20 or kinds["PRCP"].count() < 3:
            continue
        place = own.agg(*(f(c) for f in (F.avg, F.stddev) for c in ("lat", "lon"))).first()
        values = [kinds[k].agg(F.avg("value"), F.stddev("value")).first() for k in kinds]
        out.append((num, *place, *(x for pair in values for x in pair)))
    rows.unpersist()
    return spark.createDataFrame(out)


PLAIN = {
    f.__name__: f
    for f in (
        weekly_consumption,
        station_temperature,
        county_rates_located,
        max_decade_by_area,
        daily_statistics_report,
        cluster_climate_profile,
    )
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session("baseline", os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")

    def seconds(query) -> float:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            query(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        return statistics.median(times[1:])

    print(f"| analysis ({os.path.basename(sf_dir)}) | plain form, s | library, s |\n|---|---|---|")
    for name, plain in PLAIN.items():
        print(f"| `{name}` | {seconds(plain):.2f} | {seconds(QUERIES[name]):.2f} |", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
