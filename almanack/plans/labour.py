"""Labour-market series: best decade per series, and county rates on the map."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanack.functions import decade, drop_ends
from almanack.operators.aggregates import argmax_by_key
from almanack.operators.joins import BROADCAST_BYTES, contains_join, nested_pair_join

# The measure code that ends the id of an unemployment rate, and
# the characters around the area code in an id.
RATE_SUFFIX = "03"
AREA_LEFT, AREA_RIGHT = 3, 2


def best_decades(rates: DataFrame, suffix: str = RATE_SUFFIX) -> DataFrame:
    """``id, decade, mean``: the decade with the highest mean; the earlier on a tie.

    All periods of the input count, also any yearly summary period among them.
    """
    means = (
        rates.filter(F.col("id").endswith(suffix))
        .groupBy("id", decade("year").alias("decade"))
        .agg(F.avg("value").alias("mean"))
    )
    return argmax_by_key(means, ["id"], "decade", "mean")


def best_decades_by_area(
    rates: DataFrame, series: DataFrame, areas: DataFrame, suffix: str = RATE_SUFFIX
) -> DataFrame:
    """The best decades with the title of the series and the name of the area."""
    titled = best_decades(rates, suffix).join(
        series.select(F.col("sid").alias("id"), "title"), "id"
    )
    coded = titled.withColumn("area_code", drop_ends("id", AREA_LEFT, AREA_RIGHT))
    named = areas.select(F.col("code").alias("area_code"), F.col("text").alias("area_text"))
    return named.join(coded, "area_code").select(
        "area_code", "area_text", "title", "decade", "mean"
    )


def county_rates_located(
    rates: DataFrame,
    series: DataFrame,
    zip_codes: DataFrame,
    year: int,
    period: str,
    suffix: str = RATE_SUFFIX,
    max_broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Rates of one month, paired with the counties their titles name.

    Row: ``_1`` is the pair (rate, series), ``_2`` the county with the mean
    place of its zip codes. A title names a county if it contains both the
    county's and the state's name. Titles are matched once per series, not once
    per rate: the series are few and the rates are many.
    """
    month = rates.select(F.trim("id").alias("id"), "year", "period", "value").filter(
        F.col("id").endswith(suffix) & (F.col("year") == year) & (F.col("period") == period)
    )
    counties = (
        zip_codes.filter(F.col("lat").isNotNull())
        .groupBy("county", "state")
        .agg(F.avg("lat").alias("lat"), F.avg("lon").alias("lon"))
        .select("lat", "lon", "state", "county")
    )
    located = contains_join(
        series.filter(F.col("sid").endswith(suffix)),
        counties,
        "title",
        ["county", "state"],
        max_broadcast_bytes,
    )
    pairs = nested_pair_join(month, located, "id", "sid")
    series_part = F.struct(*(F.col(f"_2.{c}") for c in series.columns))
    county_part = F.struct(*(F.col(f"_2.{c}") for c in counties.columns))
    return pairs.select(
        F.struct(F.col("_1"), series_part.alias("_2")).alias("_1"), county_part.alias("_2")
    )
