"""Readers of the files the analyses start from, one for each kind of record.

``strict`` readers raise on a bad cell; lenient ones give NULL and mark the row in
``bad_row``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from almanack import schemas
from almanack.sources.files import read_csv
from almanack.sources.text import Field, Slice, parse_delimited, parse_fixed_width

# The layout of the published files, with positions from 0, and
# the words by which their header lines are told.
STATION_SLICES = (
    Slice("sid", 0, 11, trim=False),
    Slice("lat", 12, 20, "double"),
    Slice("lon", 21, 30, "double"),
    Slice("elev", 31, 37, "double"),
    Slice("name", 41, 71, trim=False),
)
WEATHER_FIELDS = (
    Field("day", 0, "int"),
    Field("doy", 1, "int"),
    Field("month", 2, "int"),
    Field("year", 4, "int"),
    Field("precip", 5, "double", default=-1.0),
    Field("snow", 6, "double", default=-1.0),
    Field("tave", 7, "double"),
    Field("tmax", 8, "double"),
    Field("tmin", 9, "double"),
)
WEATHER_HEADER, WEATHER_MISSING = "Day", (".", (7, 8, 9))
AREA_FIELDS, AREA_HEADER = (Field("code", 1), Field("text", 2)), "area_type"
SERIES_FIELDS, SERIES_HEADER = (
    (Field("sid", 0), Field("area", 2), Field("measure", 3), Field("title", 6)),
    "area_code",
)
RATE_FIELDS, RATE_HEADER = (
    (
        Field("id", 0),
        Field("year", 1, "int"),
        Field("period", 2, "int", skip=1),
        Field("value", 3, "double"),
    ),
    "year",
)
DATE_FORMAT = "yyyyMMdd"


def read_sales(
    spark: SparkSession, path: str, trim: bool = True, strict: bool = True
) -> DataFrame:
    return read_csv(spark, path, schemas.SALES, header=True, trim=trim, strict=strict)


def read_calendar(
    spark: SparkSession, path: str, trim: bool = True, strict: bool = True
) -> DataFrame:
    return read_csv(spark, path, schemas.CALENDAR, header=True, trim=trim, strict=strict)


def read_stores(
    spark: SparkSession, path: str, trim: bool = True, strict: bool = True
) -> DataFrame:
    return read_csv(spark, path, schemas.STORE, header=True, trim=trim, strict=strict)


def read_products(
    spark: SparkSession, path: str, trim: bool = True, strict: bool = True
) -> DataFrame:
    return read_csv(spark, path, schemas.PRODUCT, header=True, trim=trim, strict=strict)


def read_stations(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    return parse_fixed_width(spark.read.text(path), STATION_SLICES, strict=strict)


def read_measurements(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    return read_csv(spark, path, schemas.MEASUREMENT, date_format=DATE_FORMAT, strict=strict)


def read_daily_weather(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """Days with a known mean, maximum and minimum; other bad numbers are -1."""
    return parse_delimited(
        spark.read.text(path),
        WEATHER_FIELDS,
        header_token=WEATHER_HEADER,
        missing=WEATHER_MISSING,
        trim=False,
        strict=strict,
    )


def read_areas(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    return _tabbed(spark, path, AREA_FIELDS, AREA_HEADER, strict)


def read_series(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    return _tabbed(spark, path, SERIES_FIELDS, SERIES_HEADER, strict)


def read_state_rates(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """Rates with the period as a number."""
    return _tabbed(spark, path, RATE_FIELDS, RATE_HEADER, strict)


def read_county_rates(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """Rates with the period as text; columns after the value are ignored."""
    return read_csv(spark, path, schemas.COUNTY_RATE, header=True, sep="\t", strict=strict)


def read_zip_codes(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    return read_csv(spark, path, schemas.ZIP_CODE, header=True, strict=strict)


def _tabbed(
    spark: SparkSession, path: str, fields: tuple[Field, ...], header: str, strict: bool
) -> DataFrame:
    lines = spark.read.text(path)
    return parse_delimited(lines, fields, sep="\t", header_token=header, strict=strict)
