"""Statistics of daily weather records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanack.operators.aggregates import mean_where, rows_at_max, share_where
from almanack.schemas import DAILY_WEATHER

RAINY = 1.0


def hottest_days(days: DataFrame) -> DataFrame:
    """All days that share the highest maximum."""
    return rows_at_max(days, "tmax")


def daily_statistics(days: DataFrame, rainy: float = RAINY) -> DataFrame:
    """One row: the hottest day, the rainy share and mean, and deviations.

    Everything comes from one pass. Of several hottest days the earliest is
    taken. A mean without rainy days is NULL. Deviations are those of the
    population.
    """
    is_rainy = F.col("precip") >= rainy
    others = [f.name for f in DAILY_WEATHER if f.name not in ("tmax", "year", "doy")]
    rank = F.struct("tmax", -F.col("year"), -F.col("doy"), *others)
    return days.agg(
        F.max_by(F.struct(*DAILY_WEATHER.names), rank).alias("hottest"),
        F.count_if(is_rainy).alias("rainy_days"),
        share_where(is_rainy).alias("rainy_percent"),
        mean_where(F.col("tmax"), is_rainy).alias("rainy_tmax"),
        F.stddev_pop("tmax").alias("tmax_std"),
        F.stddev_pop("tmin").alias("tmin_std"),
        F.stddev_pop("tave").alias("tave_std"),
    )


def monthly_averages(days: DataFrame) -> DataFrame:
    """Mean maximum and minimum by month, in order of the month."""
    return (
        days.groupBy("month")
        .agg(F.avg("tmax").alias("tmax"), F.avg("tmin").alias("tmin"))
        .orderBy("month")
    )


def yearly_sums(days: DataFrame) -> DataFrame:
    """Sum, count and mean of the maxima by year, in order of the year."""
    return (
        days.groupBy("year")
        .agg(
            F.sum("tmax").alias("tmax_sum"),
            F.count("*").alias("day_count"),
            F.avg("tmax").alias("tmax_mean"),
        )
        .orderBy("year")
    )
