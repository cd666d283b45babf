"""The test tables seen as the records the analyses read.

The test data has no sales calendar, weather stations or labour series, so
each record is derived by Spark from a whole table of the same shape.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from almanack.schemas import DAILY_WEATHER

SEASON_WEEKS = 13


_known_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table. Its schema is read from a footer once, as a catalog would keep it."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _known_schemas:
        _known_schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_known_schemas[path]).parquet(path)


def _date_id(ts: str) -> Column:
    return F.unix_date(F.to_date(ts))


# Sales star ---------------------------------------------------------------


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_extendedprice").alias("net_sales"),
        F.col("l_quantity").cast("int").alias("sales_units"),
        F.col("l_suppkey").alias("store_id"),
        _date_id("l_shipdate").alias("date_id"),
        F.col("l_partkey").alias("product_id"),
    )


def calendar(spark: SparkSession, sf_dir: str, season: bool = True) -> DataFrame:
    """A row for each day from the first to the last ship date.

    The week is the week of a 13-week season, or with ``season=False`` the week
    of the year, up to the 53rd.
    """
    shipped = F.to_date("l_shipdate")
    span = table(spark, sf_dir, "lineitem").agg(
        F.min(shipped).alias("first"), F.max(shipped).alias("last")
    )
    days = span.select(F.explode(F.sequence("first", "last")).alias("day"))
    week = F.floor((F.dayofyear("day") - 1) / 7)
    number = week % SEASON_WEEKS + 1 if season else week + 1
    return days.select(
        F.unix_date("day").alias("date_id"),
        F.year("day").alias("date_year"),
        number.cast("int").alias("week_number"),
    )


def regional_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales by the supplier's region and the part's type, so that many meet in a week."""
    region = table(spark, sf_dir, "supplier").join(
        table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    region = region.select(F.col("s_suppkey").alias("store_id"), "n_regionkey")
    kind = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"), F.xxhash64("p_type").alias("type_id")
    )
    placed = sales(spark, sf_dir).join(region, "store_id").join(kind, "product_id")
    return placed.select(
        "net_sales",
        "sales_units",
        F.col("n_regionkey").alias("store_id"),
        "date_id",
        F.col("type_id").alias("product_id"),
    )


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("store_id"),
        F.initcap("r_name").alias("channel"),
        F.col("r_name").alias("country"),
    )


def product_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("p_type")
    return (
        table(spark, sf_dir, "part")
        .select(
            F.xxhash64(kind).alias("product_id"),
            kind.alias("division"),
            F.left(kind, F.lit(3)).alias("gender"),
            F.lower(kind).alias("category"),
        )
        .distinct()
    )


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return (
        supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .select(
            F.col("s_suppkey").alias("store_id"),
            F.initcap("r_name").alias("channel"),
            F.col("n_name").alias("country"),
        )
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_brand").alias("division"),
        F.col("p_type").alias("gender"),
        F.col("p_name").alias("category"),
    )


def product_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products in few groups, for the report: type and the words of the name."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_type").alias("division"),
        F.element_at(F.split("p_name", " "), 1).alias("gender"),
        F.element_at(F.split("p_name", " "), 2).alias("category"),
    )


# Daily weather ------------------------------------------------------------


def weather_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per order: its price is the maximum, ids shape the rest."""
    tmax, day = F.round(F.col("o_totalprice") / 100), "o_orderdate"
    tmin = tmax - F.col("o_custkey") % 20
    return (
        table(spark, sf_dir, "orders")
        .select(
            F.dayofmonth(day).alias("day"),
            F.dayofyear(day).alias("doy"),
            F.month(day).alias("month"),
            F.year(day).alias("year"),
            (F.col("o_orderkey") % 40 / 10).alias("precip"),
            F.lit(-1.0).alias("snow"),
            ((tmax + tmin) / 2).alias("tave"),
            tmax.alias("tmax"),
            tmin.alias("tmin"),
        )
        .to(DAILY_WEATHER)
    )


# Stations -----------------------------------------------------------------


def measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of a user: views as maxima, purchases as minima."""
    kind = (
        F.when(F.col("event_type") == "view", "TMAX")
        .when(F.col("event_type") == "purchase", "TMIN")
        .otherwise(F.upper("event_type"))
    )
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("sid"),
        F.to_date("ts").alias("date"),
        kind.alias("measure"),
        "value",
    )


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("sid"),
        (F.col("c_acctbal") / 100).alias("lat"),
        F.col("c_nationkey").cast("double").alias("lon"),
        F.col("c_name").alias("name"),
    )


def order_measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of a customer: the priority is the measure, the price its value."""
    rank = F.substring("o_orderpriority", 1, 1)
    kind = (
        F.when(rank == "1", "TMAX").when(rank == "2", "TMIN").when(rank == "3", "PRCP")
    ).otherwise("SNOW")
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("sid"),
        F.to_date("o_orderdate").alias("date"),
        kind.alias("measure"),
        F.col("o_totalprice").alias("value"),
    )


def nation_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stations with the nation as their cluster."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("sid"),
        F.col("c_acctbal").alias("lat"),
        F.col("c_custkey").cast("double").alias("lon"),
        F.col("c_nationkey").alias("cluster"),
    )


# Labour series ------------------------------------------------------------


def state_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as values of a series; those of status P measure something else."""
    measure = F.when(F.col("o_orderstatus") == "P", "04").otherwise("03")
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("LAU"), F.col("o_custkey").cast("string"), measure).alias("id"),
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("period"),
        F.col("o_totalprice").alias("value"),
    )


def state_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.explode(F.array(F.lit("03"), F.lit("04")))
    return (
        table(spark, sf_dir, "customer")
        .select("c_custkey", "c_name", code.alias("measure"))
        .select(
            F.concat(F.lit("LAU"), F.col("c_custkey").cast("string"), "measure").alias("sid"),
            F.col("c_custkey").cast("string").alias("area"),
            "measure",
            F.col("c_name").alias("title"),
        )
    )


def _customer_nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey)


def areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _customer_nations(spark, sf_dir).select(
        F.col("c_custkey").cast("string").alias("code"), F.col("n_name").alias("text")
    )


def county_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as monthly rates, padded like the fields of the files."""
    return table(spark, sf_dir, "orders").select(
        F.rpad(F.col("o_custkey").cast("string"), 20, " ").alias("id"),
        F.year("o_orderdate").alias("year"),
        F.date_format("o_orderdate", "'M'MM").alias("period"),
        F.col("o_totalprice").alias("value"),
    )


def county_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _customer_nations(spark, sf_dir).select(
        F.col("c_custkey").cast("string").alias("sid"),
        F.col("c_nationkey").cast("string").alias("area"),
        F.col("c_mktsegment").alias("measure"),
        F.concat_ws(" ", "c_name", "n_name").alias("title"),
    )


def zip_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as zip codes: the nation is the county, a last digit the state."""
    return _customer_nations(spark, sf_dir).select(
        F.col("c_custkey").cast("string").alias("zip_code"),
        F.col("c_acctbal").alias("lat"),
        F.col("c_custkey").cast("double").alias("lon"),
        F.col("c_mktsegment").alias("city"),
        F.right("c_name", F.lit(1)).alias("state"),
        F.col("n_name").alias("county"),
    )
