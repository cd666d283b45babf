"""The analyses: each takes the records of ``almanack.schemas`` as DataFrames."""

from .climate import (
    climate_profile,
    cluster_moments,
    cluster_stations,
    merge_clusters,
    profile_of_moments,
    station_cluster_profile,
    station_observations,
)
from .consumption import weekly_consumption, weekly_consumption_sql, weekly_sales
from .labour import best_decades, best_decades_by_area, county_rates_located
from .report import weekly_report, weekly_report_json
from .temperature import station_temperature, station_temperature_sql
from .weather import daily_statistics, hottest_days, monthly_averages, yearly_sums

__all__ = [
    "best_decades",
    "best_decades_by_area",
    "climate_profile",
    "cluster_moments",
    "cluster_stations",
    "county_rates_located",
    "daily_statistics",
    "hottest_days",
    "merge_clusters",
    "monthly_averages",
    "profile_of_moments",
    "station_cluster_profile",
    "station_observations",
    "station_temperature",
    "station_temperature_sql",
    "weekly_consumption",
    "weekly_consumption_sql",
    "weekly_report",
    "weekly_report_json",
    "weekly_sales",
    "yearly_sums",
]
