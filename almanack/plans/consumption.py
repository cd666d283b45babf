"""Weekly consumption: units and net sales by week, country and product.

The week is the week of the season, so one key such as ``Y18_W2`` joins the
days of all seasons of a year. The sums are per week, store and product; the
result is not summed again by its id, which names only the country and the
product's attributes, so an id can occur in several rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almanack.functions import season_week_key, underscored
from almanack.operators.joins import BROADCAST_BYTES, stored_dimension


def weekly_sales(
    sales: DataFrame, calendar: DataFrame, max_broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Units and net sales, in cents rounded once, by week, store and product."""
    # The key is text made of two small numbers. Grouping by the numbers keeps
    # text out of the hash tables and the shuffle; the text is made per group. A
    # NULL in either makes the key NULL, so it must do so before grouping.
    year, week = F.col("date_year") % 1000, F.col("week_number")
    weeks = calendar.select(
        "date_id",
        F.when(week.isNotNull(), year).alias("short_year"),
        F.when(year.isNotNull(), week).alias("season_week"),
    )
    # A sale must not be shuffled by its day: the days are few and all fat.
    s, c = sales.alias("s"), stored_dimension(weeks, max_broadcast_bytes).alias("c")
    summed = (
        s.join(c, F.col("s.date_id") == F.col("c.date_id"))
        .groupBy("short_year", "season_week", "store_id", "product_id")
        .agg(
            F.sum("sales_units").alias("sales_units"),
            F.round(F.sum("net_sales"), 2).alias("net_sales"),
        )
    )
    return summed.select(
        season_week_key("short_year", "season_week").alias("week"),
        "store_id",
        "product_id",
        "sales_units",
        "net_sales",
    )


def weekly_consumption(
    sales: DataFrame,
    calendar: DataFrame,
    store: DataFrame,
    product: DataFrame,
    max_broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``id, sales_units, net_sales``. Summing comes before the dimension joins."""
    stores = stored_dimension(store.select("store_id", "country"), max_broadcast_bytes)
    products = stored_dimension(
        product.select("product_id", "division", "gender", "category"), max_broadcast_bytes
    )
    weekly = weekly_sales(sales, calendar, max_broadcast_bytes)
    located = weekly.join(stores, "store_id").join(products, "product_id")
    return located.select(
        underscored("week", "country", "division", "gender", "category").alias("id"),
        "sales_units",
        "net_sales",
    )


def weekly_consumption_sql(
    spark: SparkSession,
    sales: DataFrame,
    calendar: DataFrame,
    store: DataFrame,
    product: DataFrame,
    max_broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The same result from one SQL statement; it leaves no view in the session."""
    return spark.sql(
        """
        SELECT concat('Y', week.year, '_W', week.number, '_', country, '_', division, '_',
                      gender, '_', category) AS id,
               week.`Sales Units` AS sales_units, round(week.`Net Sales`, 2) AS net_sales
        FROM (
          SELECT day.year, day.number, store_id, product_id,
                 sum(sales_units) AS `Sales Units`, sum(net_sales) AS `Net Sales`
          FROM {sales} JOIN (
            SELECT date_id, IF(week_number IS NULL, NULL, date_year % 1000) AS year,
                   IF(date_year IS NULL, NULL, week_number) AS number
            FROM {days}) AS day USING (date_id)
          GROUP BY ALL) AS week
        JOIN {stores} USING (store_id)
        JOIN {products} USING (product_id)
        """,
        sales=sales,
        days=stored_dimension(
            calendar.select("date_id", "date_year", "week_number"), max_broadcast_bytes
        ),
        stores=stored_dimension(store.select("store_id", "country"), max_broadcast_bytes),
        products=stored_dimension(
            product.select("product_id", "division", "gender", "category"), max_broadcast_bytes
        ),
    )
