"""One query for each operator and analysis, over the whole test tables.

Computed doubles are rounded, because their last digits depend on the order in
which an engine adds. Dates leave as text, nested columns as plain ones.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almanack import functions as X
from almanack import operators as O
from almanack import plans as P
from almanack import schemas
from almanack import sources as S
from almanack.registry import standins as st
from almanack.registry.standins import table
from almanack.session import staging_path
from almanack.sources.records import RATE_FIELDS, RATE_HEADER, STATION_SLICES

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def _query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _rounded(df: DataFrame, *columns: str, digits: int = 4) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _iso(date: str):
    return F.date_format(date, "yyyy-MM-dd")


# Analyses -----------------------------------------------------------------


def _star(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, ...]:
    return (
        st.regional_sales(spark, sf_dir),
        st.calendar(spark, sf_dir),
        st.regions(spark, sf_dir),
        st.product_types(spark, sf_dir),
    )


@_query
def weekly_consumption(spark, sf_dir):
    return P.weekly_consumption(*_star(spark, sf_dir))


@_query
def weekly_consumption_sql(spark, sf_dir):
    return P.weekly_consumption_sql(spark, *_star(spark, sf_dir))


def _report_star(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, ...]:
    return (
        st.sales(spark, sf_dir),
        st.calendar(spark, sf_dir, season=False),
        st.stores(spark, sf_dir),
        st.product_lines(spark, sf_dir),
    )


@_query
def weekly_report_pivot(spark, sf_dir):
    return P.weekly_report(*_report_star(spark, sf_dir))


@_query
def weekly_report_documents(spark, sf_dir):
    return P.weekly_report_json(*_report_star(spark, sf_dir))


@_query
def station_temperature(spark, sf_dir):
    found = P.station_temperature(st.measurements(spark, sf_dir), st.stations(spark, sf_dir))
    return _rounded(found, "tave", "lat", digits=8)


@_query
def station_temperature_sql(spark, sf_dir):
    found = P.station_temperature_sql(
        spark, st.measurements(spark, sf_dir), st.stations(spark, sf_dir)
    )
    return _rounded(found, "tave", "lat", digits=8)


@_query
def cluster_climate_profile(spark, sf_dir):
    observations = st.order_measurements(spark, sf_dir).join(
        O.bounded_broadcast(st.nation_clusters(spark, sf_dir)), "sid"
    )
    profile = P.climate_profile(observations)
    return _rounded(profile, *(c for c in profile.columns if c != "num"), digits=3)


@_query
def station_cluster_profile(spark, sf_dir):
    """The clusters' moments put together again: the same whatever the clusters are."""
    observations = P.station_observations(
        st.order_measurements(spark, sf_dir), st.stations(spark, sf_dir)
    )
    clusters = O.stored_dimension(P.cluster_moments(observations))
    profile = P.profile_of_moments(P.merge_clusters(clusters))
    return _rounded(profile, *(c for c in profile.columns if c != "observations"), digits=3)


@_query
def max_decade_by_area(spark, sf_dir):
    found = P.best_decades_by_area(
        st.state_rates(spark, sf_dir),
        st.state_series(spark, sf_dir),
        st.areas(spark, sf_dir),
    )
    return _rounded(found, "mean", digits=6)


@_query
def county_rates_located(spark, sf_dir):
    found = P.county_rates_located(
        st.county_rates(spark, sf_dir),
        st.county_series(spark, sf_dir),
        st.zip_codes(spark, sf_dir),
        year=1997,
        period="M10",
        suffix="3",
    )
    return found.select(
        F.col("_1._1.id").alias("id"),
        F.col("_1._1.year").alias("year"),
        F.col("_1._1.period").alias("period"),
        F.col("_1._1.value").alias("value"),
        F.col("_1._2.title").alias("title"),
        F.round("_2.lat", 4).alias("lat"),
        F.round("_2.lon", 4).alias("lon"),
        F.col("_2.state").alias("state"),
        F.col("_2.county").alias("county"),
    )


@_query
def daily_statistics_report(spark, sf_dir):
    report = P.daily_statistics(st.weather_days(spark, sf_dir))
    flat = report.select("hottest.*", *(c for c in report.columns if c != "hottest"))
    return _rounded(flat, "rainy_percent", "rainy_tmax", "tmax_std", "tmin_std", "tave_std")


# Sources and sinks --------------------------------------------------------


def _staged(df: DataFrame, name: str, **options) -> str:
    path = staging_path(df.sparkSession, name)
    df.write.options(**options).csv(path)
    return path


@_query
def scan_csv_schema(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", "o_orderstatus", "o_custkey"
    )
    path = _staged(orders, "orders", header=True)
    schema = "order_id long, price double, status string, customer_id long"
    read = S.read_csv(spark, path, schema, header=True)
    return read.select("customer_id", "order_id", "price")


@_query
def scan_csv_lenient(spark, sf_dir):
    """Orders of status P have a price that is no number."""
    spoiled = F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(
        F.col("o_totalprice").cast("string")
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", spoiled.alias("price"))
    path = _staged(orders, "orders", header=True)
    return S.read_csv(spark, path, "order_id long, price double", header=True, strict=False)


@_query
def parse_lenient(spark, sf_dir):
    """The same as delimited text."""
    price = F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(
        F.col("o_totalprice").cast("string")
    )
    lines = table(spark, sf_dir, "orders").select(
        F.concat_ws(",", F.col("o_orderkey").cast("string"), price).alias("value")
    )
    fields = [S.Field("order_id", 0, "bigint"), S.Field("price", 1, "double")]
    return S.parse_delimited(lines, fields, strict=False)


@_query
def scan_csv_cast(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    path = _staged(orders, "orders", header=True)
    casts = {"o_orderkey": "bigint", "o_totalprice": "double"}
    return S.read_csv_cast(spark, path, casts, drop=["o_orderstatus"])


@_query
def scan_csv_dates(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        F.col("user_id"), F.to_date("ts").alias("date"), "event_type", "value", "props"
    )
    path = _staged(events, "events", dateFormat="yyyyMMdd")
    read = S.read_measurements(spark, path)
    return read.withColumn("date", _iso("date"))


@_query
def scan_tsv(spark, sf_dir):
    rates = st.county_rates(spark, sf_dir)
    path = _staged(rates, "rates", header=True, sep="\t", ignoreTrailingWhiteSpace=False)
    read = S.read_county_rates(spark, path)
    typed = read.select(F.trim("id").alias("id"), "year", "period", "value")
    return typed.to(schemas.COUNTY_RATE)


@_query
def parse_fixed_width(spark, sf_dir):
    line = F.format_string(
        "US%s %8.4f %9.4f %6.1f    %-30s",
        F.lpad(F.col("c_custkey").cast("string"), 9, "0"),
        F.col("c_acctbal") / 100,
        F.col("c_custkey").cast("double") % 360 - 180,
        F.col("c_nationkey") * 10.5,
        F.col("c_name"),
    )
    lines = table(spark, sf_dir, "customer").select(line.alias("value"))
    return S.parse_fixed_width(lines, STATION_SLICES)


@_query
def parse_delimited(spark, sf_dir):
    line = F.concat_ws(
        "\t",
        F.rpad(F.col("o_orderkey").cast("string"), 12, " "),
        F.year("o_orderdate").cast("string"),
        F.date_format("o_orderdate", "'M'MM"),
        F.lpad(F.col("o_totalprice").cast("string"), 14, " "),
        F.col("o_orderstatus"),
    )
    body = table(spark, sf_dir, "orders").select(line.alias("value"))
    # Pending orders have a header line before them, as in files joined end to end.
    header = F.lit("series_id\tyear\tperiod\tvalue\tfootnote")
    with_header = F.when(F.col("value").endswith("P"), F.array(header, "value"))
    lines = body.select(
        F.explode(F.coalesce(with_header, F.array("value"))).alias("value")
    )
    return S.parse_delimited(lines, RATE_FIELDS, sep="\t", header_token=RATE_HEADER)


@_query
def parse_missing_markers(spark, sf_dir):
    number, kind = F.col("value").cast("string"), F.col("event_type")
    line = F.concat_ws(
        ",",
        F.col("event_id").cast("string"),
        F.when(kind == "signup", "T").otherwise(number),
        F.when(kind == "error", ".").otherwise(number),
        F.when(kind == "click", ".").otherwise(F.col("user_id").cast("string")),
    )
    lines = table(spark, sf_dir, "events").select(line.alias("value"))
    return S.parse_delimited(
        lines,
        [
            S.Field("id", 0, "bigint"),
            S.Field("precip", 1, "double", default=-1.0),
            S.Field("tmax", 2, "double"),
            S.Field("tmin", 3, "double"),
        ],
        missing=(".", [2, 3]),
    )


@_query
def sink_json_roundtrip(spark, sf_dir):
    path = staging_path(spark, "customer")
    customer = table(spark, sf_dir, "customer")
    S.write_json(customer, path)
    return spark.read.schema(customer.schema).json(path)


@_query
def sink_text_roundtrip(spark, sf_dir):
    path = staging_path(spark, "lines")
    customer = table(spark, sf_dir, "customer")
    S.write_lines(customer.select("c_custkey", "c_name", "c_mktsegment"), path)
    return spark.read.text(path)


# Projections and filters --------------------------------------------------


@_query
def project_columns(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem")
    return (
        lineitem.select("l_suppkey", "l_orderkey", "l_linenumber", "l_quantity", "l_tax")
        .drop("l_tax")
        .withColumnRenamed("l_quantity", "sales_units")
    )


@_query
def project_computed(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem")
    return lineitem.select(
        "l_orderkey",
        F.round(X.mean_fahrenheit("l_quantity", "l_extendedprice"), 4).alias("tave"),
        (F.col("l_linenumber") * 10).alias("l_linenumber"),
    )


@_query
def filter_equality(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.filter(F.col("event_type") == "view").select("event_id", "user_id", "value")


@_query
def filter_conjunction(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.filter(
        F.col("o_orderkey").cast("string").endswith("3")
        & (F.col("o_orderstatus") == "F")
        & (F.col("o_orderpriority") == "1-URGENT")
    ).select("o_orderkey", "o_custkey", "o_totalprice")


@_query
def filter_not_null(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("known_status")
    )
    return orders.filter(F.col("known_status").isNotNull())


# Joins --------------------------------------------------------------------


@_query
def join_equi(spark, sf_dir):
    o, c = table(spark, sf_dir, "orders").alias("o"), table(spark, sf_dir, "customer").alias("c")
    return (
        o.join(c, F.col("o.o_custkey") == F.col("c.c_custkey"))
        .drop(F.col("c.c_custkey"))
        .select("o.o_orderkey", "o.o_custkey", "c.c_name", "o.o_totalprice")
    )


@_query
def join_using(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "custkey")
    customer = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "custkey")
    return orders.join(customer, "custkey").select("custkey", "o_orderkey", "c_mktsegment")


def _daily(events: DataFrame, kind: str, name: str) -> DataFrame:
    return (
        events.filter(F.col("event_type") == kind)
        .groupBy("user_id", F.to_date("ts").alias("date"))
        .agg(F.sum("value").alias(name))
    )


@_query
def join_using_two_keys(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    views, purchases = _daily(events, "view", "viewed"), _daily(events, "purchase", "purchased")
    joined = views.join(purchases, ["user_id", "date"])
    return _rounded(joined.withColumn("date", _iso("date")), "viewed", "purchased")


@_query
def join_nested_pair(spark, sf_dir):
    pairs = O.nested_pair_join(
        table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer"), "o_custkey", "c_custkey"
    )
    return pairs.select(
        F.col("_1.o_orderkey").alias("o_orderkey"),
        F.col("_1.o_totalprice").alias("o_totalprice"),
        F.col("_2.c_name").alias("c_name"),
    )


@_query
def join_contains(spark, sf_dir):
    parts = table(spark, sf_dir, "part").withColumn("title", F.concat_ws(" ", "p_name", "p_brand"))
    word = F.element_at(F.split("p_name", " "), 1)
    groups = parts.groupBy(word.alias("word"), F.col("p_brand").alias("brand")).agg(
        F.round(F.avg("p_retailprice"), 4).alias("price")
    )
    found = O.contains_join(parts.select("p_partkey", "title"), groups, "title", ["word", "brand"])
    return found.select("p_partkey", "title", "word", "brand", "price")


# Aggregations -------------------------------------------------------------


@_query
def avg_by_key(spark, sf_dir):
    found = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.avg("o_totalprice").alias("mean_price")
    )
    return _rounded(found, "mean_price", digits=6)


@_query
def sum_round_by_keys(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem")
    return lineitem.groupBy("l_suppkey", "l_returnflag", "l_linestatus").agg(
        F.sum("l_linenumber").alias("units"),
        F.round(F.sum("l_extendedprice"), 2).alias("net"),
    )


@_query
def avg_by_two_keys(spark, sf_dir):
    found = table(spark, sf_dir, "orders").groupBy(
        "o_custkey", X.decade(F.year("o_orderdate")).alias("decade")
    )
    means = found.agg(
        F.avg("o_totalprice").alias("mean_price"), F.avg("o_orderkey").alias("mean_key")
    )
    return _rounded(means, "mean_price", "mean_key", digits=6)


@_query
def sum_count_by_key(spark, sf_dir):
    found = P.yearly_sums(
        table(spark, sf_dir, "orders").select(
            F.year("o_orderdate").alias("year"), F.col("o_totalprice").alias("tmax")
        )
    )
    return _rounded(found, "tmax_sum", "tmax_mean", digits=2)


@_query
def argmax_by_key(spark, sf_dir):
    means = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey", X.decade(F.year("o_orderdate")).alias("decade"))
        .agg(F.avg("o_totalprice").alias("mean"))
    )
    return _rounded(O.argmax_by_key(means, ["o_custkey"], "decade", "mean"), "mean", digits=6)


@_query
def rows_at_max(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.year("o_orderdate").alias("year"), "o_orderpriority"
    )
    return O.rows_at_max(orders, "year")


@_query
def argmax_row(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return O.argmax_row(events, F.desc("value"), F.asc("event_id")).select(
        "event_id", "user_id", "event_type", "value"
    )


@_query
def conditional_share(spark, sf_dir):
    large = F.col("value") >= 100
    return table(spark, sf_dir, "events").agg(
        F.count_if(large).alias("large"), F.round(O.share_where(large), 6).alias("percent")
    )


@_query
def conditional_avg(spark, sf_dir):
    large = F.col("value") >= 100
    return table(spark, sf_dir, "events").agg(
        F.round(O.mean_where(F.col("value"), large), 4).alias("large_mean"),
        F.round(O.mean_where(F.col("value"), F.col("value") < 0), 4).alias("none_mean"),
    )


@_query
def stddev_population(spark, sf_dir):
    return table(spark, sf_dir, "events").agg(
        F.round(F.stddev_pop("value"), 4).alias("value_std"),
        F.round(F.stddev_pop("user_id"), 4).alias("user_std"),
    )


@_query
def mean_stddev_sample(spark, sf_dir):
    return table(spark, sf_dir, "events").agg(
        F.round(F.avg("value"), 4).alias("mean"), F.round(F.stddev_samp("value"), 4).alias("std")
    )


@_query
def monthly_averages(spark, sf_dir):
    return _rounded(P.monthly_averages(st.weather_days(spark, sf_dir)), "tmax", "tmin")


@_query
def having_min_counts(spark, sf_dir):
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey)
    enough = {"F": 190, "O": 190, "P": 190}
    return O.having_min_counts(joined, ["c_nationkey"], "o_orderstatus", enough)


# Limits and samples -------------------------------------------------------


@_query
def limit_before_join(spark, sf_dir):
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    first = orders.orderBy("o_orderkey").limit(1000)
    return first.join(customer, first.o_custkey == customer.c_custkey).select(
        "o_orderkey", "o_totalprice", "c_name"
    )


@_query
def first_rows_before_join(spark, sf_dir):
    """As many rows as no single task should hold."""
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    first = O.first_rows(orders, 10_000, "o_orderdate", "o_orderkey")
    return first.join(customer, first.o_custkey == customer.c_custkey).select(
        "o_orderkey", "o_totalprice", "c_name"
    )


@_query
def station_temperature_first(spark, sf_dir):
    found = P.station_temperature(
        st.measurements(spark, sf_dir), st.stations(spark, sf_dir), limit=1_500
    )
    return _rounded(found, "tave", "lat", digits=8)


@_query
def sorted_positions(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    placed = O.with_positions(orders, F.desc("o_totalprice"), "o_orderkey")
    return placed.select("o_orderkey", "o_totalprice", "position")


@_query
def monthly_positions(spark, sf_dir):
    return O.with_positions(P.monthly_averages(st.weather_days(spark, sf_dir)), "month").select(
        "position", "month", F.round("tmax", 4).alias("tmax")
    )


@_query
def top_n(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10).select(
        "o_orderkey", "o_custkey", "o_totalprice"
    )


@_query
def sample_rows(spark, sf_dir):
    """What holds of a sample for any seed: rows not of the table, repeated ones, its size."""
    events = table(spark, sf_dir, "events")
    sample = events.sample(False, 0.1, 7).select("event_id")
    found = sample.groupBy("event_id").count().join(
        events.groupBy("event_id").agg(F.count("*").alias("there")), "event_id", "full"
    )
    drawn, there = F.coalesce("count", F.lit(0)), F.coalesce("there", F.lit(0))
    share = F.sum(drawn) / F.sum(there)
    return found.agg(
        F.count_if((drawn > 0) & (there == 0)).alias("unknown"),
        F.count_if(drawn > there).alias("repeated"),
        share.between(0.05, 0.15).alias("size_as_asked"),
    )


@_query
def sample_rows_by_key(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    sample = O.sample_by_key(events, 0.1, "event_id", seed=7)
    return sample.select("event_id", "user_id", "event_type")


# Scalar functions ---------------------------------------------------------


@_query
def fn_string(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    return customer.select(
        "c_custkey",
        X.underscored("c_name", F.lit("x"), "c_mktsegment").alias("joined"),
        F.trim(F.concat(F.lit("  "), "c_mktsegment", F.lit(" "))).alias("trimmed"),
        X.drop_ends("c_name", 3, 2).alias("middle"),
        X.char_range("c_name", 2, 9).alias("piece"),
        X.season_week_key(F.col("c_nationkey") + 1990, F.col("c_custkey") % 13 + 1).alias("week"),
    )


@_query
def fn_cast(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    text = F.col("o_totalprice").cast("string")
    return orders.select(
        "o_orderkey",
        F.col("o_orderkey").cast("string").cast("int").alias("as_int"),
        F.col("o_orderkey").cast("string").alias("as_text"),
        text.cast("double").alias("as_double"),
        X.number_or(F.when(F.col("o_orderstatus") == "P", "T").otherwise(text)).alias("or_default"),
    )


@_query
def fn_math(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    angle = X.day_angle("o_orderdate")
    return orders.select(
        "o_orderkey",
        (F.year("o_orderdate") % 1000).alias("short_year"),
        X.decade(F.year("o_orderdate")).alias("decade"),
        F.round(F.sin(angle), 8).alias("sine"),
        F.round(F.cos(angle), 8).alias("cosine"),
        F.round(F.sqrt(F.col("o_totalprice")), 6).alias("root"),
        F.round((F.col("o_totalprice") - 32) * 5 / 9 + 1, 4).alias("scaled"),
    )


@_query
def fn_date(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    text = F.date_format("o_orderdate", "yyyyMMdd")
    return orders.select(
        "o_orderkey",
        text.alias("compact"),
        F.dayofyear(F.to_date(text, "yyyyMMdd")).alias("doy"),
        _iso(F.to_date(text, "yyyyMMdd")).alias("date"),
    )


# Features, clusters and fits ----------------------------------------------


@_query
def assemble_features(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    features = O.assemble(customer, ["c_acctbal", "c_nationkey"], "features")
    values = vector_to_array("features")
    return features.select("c_custkey", values[0].alias("x0"), values[1].alias("x1"))


@_query
def kmeans_fit(spark, sf_dir):
    """What holds for any seed: stations without a cluster, or farther from it than from another."""
    stations = st.stations(spark, sf_dir)
    model = O.fit_kmeans(stations, ["lat", "lon"], k=2000, seed=1)
    rows = [(i, *map(float, c)) for i, c in enumerate(model.clusterCenters())]
    centers = spark.createDataFrame(rows, "nearest int, lat double, lon double")
    assigned = O.assign_kmeans(stations, ["lat", "lon"], model)
    found = O.nearest_center(assigned, centers, ["lat", "lon"], "nearest")
    for own in ("cluster", "nearest"):
        place = centers.select(
            F.col("nearest").alias(own), F.struct("lat", "lon").alias(f"{own}_place")
        )
        found = found.join(O.bounded_broadcast(place), own, "left")

    def distance(own):
        return F.hypot(F.col("lat") - F.col(f"{own}.lat"), F.col("lon") - F.col(f"{own}.lon"))

    farther = distance("cluster_place") > distance("nearest_place") + 1e-6
    return found.agg(
        F.count("*").alias("stations"),
        F.count_if(F.col("cluster").isNull()).alias("without"),
        F.count_if(farther).alias("misplaced"),
    )


@_query
def kmeans_assign_many(spark, sf_dir):
    """A center for every second customer: more than are compared one by one."""
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_acctbal").alias("x"), (F.col("c_custkey") * 7 % 1000).alias("y")
    )
    centers = customer.where("c_custkey % 2 = 0").select(
        F.col("c_custkey").alias("cluster"), (F.col("x") + 1.5).alias("x"), (F.col("y") + 0.5).alias("y")
    )
    return O.nearest_center(customer, centers, ["x", "y"], scan_centers=100).select(
        "c_custkey", "cluster"
    )


@_query
def kmeans_assign(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_nationkey")
    centers = customer.groupBy(F.col("c_nationkey").alias("cluster")).agg(
        F.round(F.avg("c_acctbal"), 4).alias("c_acctbal"),
        F.avg("c_nationkey").alias("c_nationkey"),
    )
    return O.nearest_center(customer, centers, ["c_acctbal", "c_nationkey"]).select(
        "c_custkey", "cluster"
    )


@_query
def linear_fit_by_group(spark, sf_dir):
    angle = X.day_angle("o_orderdate")
    waves = table(spark, sf_dir, "orders").select(
        "o_orderpriority",
        F.sin(angle).alias("sine"),
        F.cos(angle).alias("cosine"),
        F.col("o_totalprice").alias("value"),
    )
    fit = O.fit_plane(F.col("sine"), F.col("cosine"), F.col("value"))
    fits = waves.groupBy("o_orderpriority").agg(fit.alias("fit")).select("o_orderpriority", "fit.*")
    return _rounded(fits, "intercept", "b1", "b2")


@_query
def seasonal_amplitude(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    wave = O.seasonal_amplitude(F.col("o_orderdate"), F.col("o_totalprice"))
    found = orders.groupBy("o_orderstatus", "o_orderpriority").agg(wave.alias("amplitude"))
    return _rounded(found, "amplitude")
