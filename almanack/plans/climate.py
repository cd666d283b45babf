"""Clusters of stations by place, and the climate of each cluster."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanack.functions import day_angle
from almanack.operators.clustering import assign_kmeans, fit_kmeans
from almanack.operators.joins import BROADCAST_BYTES, stored_dimension
from almanack.operators.moments import (
    mean_of,
    merge_moments,
    moments,
    sample_deviation,
    wave_amplitude,
)
from almanack.operators.regression import SINGULAR, amplitude

TMAX, TMIN, PRCP = "TMAX", "TMIN", "PRCP"
LOCATION = ("lat", "lon")


def cluster_stations(stations: DataFrame, k: int = 2000, seed: int = 1) -> DataFrame:
    """Add ``cluster``: k-means on latitude and longitude in degrees."""
    model = fit_kmeans(stations, LOCATION, k, seed)
    return assign_kmeans(stations, LOCATION, model)


def climate_profile(
    observations: DataFrame, min_tmax: int = 20, min_tmin: int = 20, min_prcp: int = 3
) -> DataFrame:
    """Eleven statistics for each cluster with enough rows of each measure.

    ``observations`` has cluster, lat, lon, date, measure and value. All
    clusters are profiled by one aggregation with one shuffle, which carries at
    most one partial row per cluster from each map task, however large a
    cluster is. The place of a cluster is the mean over its observations, not
    over its stations. Deviations are those of a sample.
    """

    def of(kind: str, value: Column) -> Column:
        return F.when(F.col("measure") == kind, value)

    angle = day_angle("date")
    rows = observations.select(
        F.col("cluster").alias("num"),
        "lat",
        "lon",
        "measure",
        of(TMAX, F.col("value")).alias("hi"),
        of(TMIN, F.col("value")).alias("lo"),
        of(PRCP, F.col("value")).alias("wet"),
        F.sin(angle).alias("sine"),
        F.cos(angle).alias("cosine"),
    )
    sine, cosine = F.col("sine"), F.col("cosine")
    enough = (
        (F.count_if(F.col("measure") == TMAX) >= min_tmax)
        & (F.count_if(F.col("measure") == TMIN) >= min_tmin)
        & (F.count_if(F.col("measure") == PRCP) >= min_prcp)
    )
    return (
        rows.groupBy("num")
        .agg(
            F.avg("lat").alias("lat"),
            F.avg("lon").alias("lon"),
            F.stddev_samp("lat").alias("latstd"),
            F.stddev_samp("lon").alias("lonstd"),
            F.avg("hi").alias("tmax"),
            F.avg("lo").alias("tmin"),
            F.stddev_samp("hi").alias("tmaxstd"),
            F.stddev_samp("lo").alias("tminstd"),
            F.avg("wet").alias("precip"),
            amplitude(sine, cosine, F.col("hi")).alias("tmax_seasonal_var"),
            amplitude(sine, cosine, F.col("lo")).alias("tmin_seasonal_var"),
            enough.alias("enough"),
        )
        .filter("enough")
        .drop("enough")
    )


def cluster_moments(observations: DataFrame) -> DataFrame:
    """The moments that a profile is made of, for each cluster: these can be merged."""

    def of(kind: str) -> Column:
        return F.when(F.col("measure") == kind, F.col("value"))

    angle = day_angle("date")
    wave = F.sin(angle), F.cos(angle)
    kinds = {"tmax": TMAX, "tmin": TMIN, "precip": PRCP}
    rows = [F.count_if(F.col("measure") == kind).alias(f"{name}_rows") for name, kind in kinds.items()]
    return observations.groupBy(F.col("cluster").alias("num")).agg(
        F.count("*").alias("observations"),
        *rows,
        moments(F.col("lat")).alias("lat"),
        moments(F.col("lon")).alias("lon"),
        *(moments(of(kind)).alias(name) for name, kind in kinds.items()),
        moments(*wave, of(TMAX)).alias("tmax_wave"),
        moments(*wave, of(TMIN)).alias("tmin_wave"),
    )


def merge_clusters(clusters: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The moments of several clusters as one: of all, or of those that agree in ``by``."""
    columns = ["lat", "lon", "tmax", "tmin", "precip", "tmax_wave", "tmin_wave"]
    counts = ["observations", "tmax_rows", "tmin_rows", "precip_rows"]
    merged = merge_moments(clusters, columns, by)
    sums = clusters.groupBy(*by).agg(*(F.sum(c).alias(c) for c in counts))
    if by:
        return sums.join(merged, list(by))
    whole = sums.select(F.struct("*")).scalar()
    return merged.withColumn("_sums", whole).select("_sums.*", *columns)


def profile_of_moments(
    clusters: DataFrame, min_tmax: int = 20, min_tmin: int = 20, min_prcp: int = 3
) -> DataFrame:
    """The statistics of ``climate_profile`` from moments, with the other columns before them."""
    enough = (
        (F.col("tmax_rows") >= min_tmax)
        & (F.col("tmin_rows") >= min_tmin)
        & (F.col("precip_rows") >= min_prcp)
    )
    stats = ("lat", "lon", "tmax", "tmin", "precip", "tmax_wave", "tmin_wave")
    return clusters.where(enough).select(
        *(c for c in clusters.columns if c not in stats and not c.endswith("_rows")),
        mean_of("lat").alias("lat"),
        mean_of("lon").alias("lon"),
        sample_deviation("lat").alias("latstd"),
        sample_deviation("lon").alias("lonstd"),
        mean_of("tmax").alias("tmax"),
        mean_of("tmin").alias("tmin"),
        sample_deviation("tmax").alias("tmaxstd"),
        sample_deviation("tmin").alias("tminstd"),
        mean_of("precip").alias("precip"),
        wave_amplitude("tmax_wave", SINGULAR).alias("tmax_seasonal_var"),
        wave_amplitude("tmin_wave", SINGULAR).alias("tmin_seasonal_var"),
    )


def station_observations(
    measurements: DataFrame,
    stations: DataFrame,
    k: int = 2000,
    seed: int = 1,
    max_broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Measurements with the place and cluster of their station; the model is applied once."""
    clustered = cluster_stations(stations, k, seed).select("sid", "lat", "lon", "cluster")
    return measurements.join(stored_dimension(clustered, max_broadcast_bytes), "sid")


def station_cluster_profile(
    measurements: DataFrame,
    stations: DataFrame,
    k: int = 2000,
    seed: int = 1,
    min_tmax: int = 20,
    min_tmin: int = 20,
    min_prcp: int = 3,
    max_broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Cluster the stations and profile the clusters' measurements."""
    observations = station_observations(measurements, stations, k, seed, max_broadcast_bytes)
    return climate_profile(observations, min_tmax, min_tmin, min_prcp)
