"""Weekly report: one document per year, channel, division, gender and category.

A document has two data rows, net sales and units, with a value for each week
W1 to W52 and 0 for a week without sales. Sales of any other week, or of none,
are in ``W_other``, so that a row's weeks add up to its sales.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanack.functions import underscored
from almanack.operators.joins import BROADCAST_BYTES, stored_dimension

WEEKS = 52
OTHER = "W_other"
NET_SALES, SALES_UNITS = "Net Sales", "Sales Units"
KEYS = ("year", "channel", "division", "gender", "category")


def _wide(
    sales: DataFrame,
    calendar: DataFrame,
    store: DataFrame,
    product: DataFrame,
    weeks: int,
    max_broadcast_bytes: int,
) -> tuple[DataFrame, list[str]]:
    """A row for each key with the sums of each week, as ``net_W1``, ``units_W1`` and so on.

    The sales are summed by week, store and product first, as numbers, and only
    these sums meet the dimensions and are gathered by key.
    """
    dates = calendar.select(
        "date_id", (F.col("date_year") % 1000).alias("year"), F.col("week_number").alias("week")
    )
    stores = store.select("store_id", F.upper("channel").alias("channel"))
    products = product.select("product_id", "division", "gender", "category")
    sums = (
        sales.join(stored_dimension(dates, max_broadcast_bytes), "date_id")
        .groupBy("year", "week", "store_id", "product_id")
        .agg(F.sum("net_sales").alias("net"), F.sum("sales_units").cast("double").alias("units"))
    )
    keyed = sums.join(stored_dimension(stores, max_broadcast_bytes), "store_id").join(
        stored_dimension(products, max_broadcast_bytes), "product_id"
    )
    # A sparse pivot: sums by key and slot first, of which a key has a row for each week with
    # sales, then these few are set in place. Slot 0 is for weeks without a column.
    slot = F.when(F.col("week").between(1, weeks), F.col("week")).otherwise(F.lit(0)).cast("int")
    slots = {f"W{n}": n for n in range(1, weeks + 1)} | {OTHER: 0}
    filled = (
        keyed.withColumn("slot", slot)
        .groupBy(*KEYS)
        .pivot("slot", list(slots.values()))
        .agg(F.sum("net").alias("net"), F.sum("units").alias("units"))
    )
    totals = [
        F.coalesce(F.round(F.col(f"{n}_{measure}"), 2), F.lit(0.0)).alias(f"{measure}_{name}")
        for measure in ("net", "units")
        for name, n in slots.items()
    ]
    year = F.concat(F.lit("RY"), F.col("year").cast("string")).alias("year")
    wide = filled.select(year, *KEYS[1:], *totals)
    return wide.withColumn("unique_key", underscored(*KEYS)), list(slots)


def _weeks(measure: str, columns: list[str]) -> Column:
    return F.struct(*(F.col(f"{measure}_{w}").alias(w) for w in columns))


def weekly_report(
    sales: DataFrame,
    calendar: DataFrame,
    store: DataFrame,
    product: DataFrame,
    weeks: int = WEEKS,
    max_broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Long form: ``unique_key``, the keys, ``row_id``, W1 … W52 and ``W_other``."""
    wide, columns = _wide(sales, calendar, store, product, weeks, max_broadcast_bytes)
    rows = F.array(
        F.struct(F.lit(NET_SALES).alias("row_id"), _weeks("net", columns).alias("weeks")),
        F.struct(F.lit(SALES_UNITS).alias("row_id"), _weeks("units", columns).alias("weeks")),
    )
    return wide.select("unique_key", *KEYS, F.explode(rows).alias("data")).select(
        "unique_key", *KEYS, "data.row_id", "data.weeks.*"
    )


def weekly_report_json(
    sales: DataFrame,
    calendar: DataFrame,
    store: DataFrame,
    product: DataFrame,
    weeks: int = WEEKS,
    max_broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """One JSON document per key, in ``value``. A document always has two rows."""
    wide, columns = _wide(sales, calendar, store, product, weeks, max_broadcast_bytes)
    data_rows = F.array(
        F.struct(F.lit(NET_SALES).alias("rowId"), _weeks("net", columns).alias("dataRow")),
        F.struct(F.lit(SALES_UNITS).alias("rowId"), _weeks("units", columns).alias("dataRow")),
    )
    document = F.struct(
        F.col("unique_key").alias("uniqueKey"),
        "division",
        "gender",
        "category",
        "channel",
        "year",
        data_rows.alias("dataRows"),
    )
    return wide.select(F.to_json(document).alias("value"))
