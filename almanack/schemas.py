"""Spark schemas of the records the analyses read and return."""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

_INT, _LONG, _DOUBLE = IntegerType(), LongType(), DoubleType()
_STRING, _DATE = StringType(), DateType()


def _record(**fields) -> StructType:
    return StructType([StructField(name, dtype) for name, dtype in fields.items()])


# Sales star. CSV files are matched to these by position, so the field order is
# the column order of the file.
SALES = _record(
    sale_id=_INT,
    net_sales=_DOUBLE,
    sales_units=_INT,
    store_id=_INT,
    date_id=_INT,
    product_id=_LONG,
)
CALENDAR = _record(date_id=_INT, calendar_day=_INT, date_year=_INT, week_number=_INT)
STORE = _record(store_id=_INT, channel=_STRING, country=_STRING)
PRODUCT = _record(product_id=_LONG, division=_STRING, gender=_STRING, category=_STRING)
CONSUMPTION = _record(id=_STRING, sales_units=_LONG, net_sales=_DOUBLE)

# Daily weather of one place.
DAILY_WEATHER = _record(
    day=_INT,
    doy=_INT,
    month=_INT,
    year=_INT,
    precip=_DOUBLE,
    snow=_DOUBLE,
    tave=_DOUBLE,
    tmax=_DOUBLE,
    tmin=_DOUBLE,
)

# Labour statistics. The period is text ("M10") in the county file and is
# read as a number (10) by the decade analysis.
AREA = _record(code=_STRING, text=_STRING)
SERIES = _record(sid=_STRING, area=_STRING, measure=_STRING, title=_STRING)
COUNTY_RATE = _record(id=_STRING, year=_INT, period=_STRING, value=_DOUBLE)
STATE_RATE = _record(id=_STRING, year=_INT, period=_INT, value=_DOUBLE)

# Places.
ZIP_CODE = _record(
    zip_code=_STRING,
    lat=_DOUBLE,
    lon=_DOUBLE,
    city=_STRING,
    state=_STRING,
    county=_STRING,
)
COUNTY_LOCATION = _record(lat=_DOUBLE, lon=_DOUBLE, state=_STRING, county=_STRING)

# Weather stations and their measurements. Temperatures are tenths of a degree
# Celsius.
MEASUREMENT = _record(sid=_STRING, date=_DATE, measure=_STRING, value=_DOUBLE)
STATION = _record(sid=_STRING, lat=_DOUBLE, lon=_DOUBLE, elev=_DOUBLE, name=_STRING)
CLUSTER_PROFILE = _record(
    num=_INT,
    lat=_DOUBLE,
    lon=_DOUBLE,
    latstd=_DOUBLE,
    lonstd=_DOUBLE,
    tmax=_DOUBLE,
    tmin=_DOUBLE,
    tmaxstd=_DOUBLE,
    tminstd=_DOUBLE,
    precip=_DOUBLE,
    tmax_seasonal_var=_DOUBLE,
    tmin_seasonal_var=_DOUBLE,
)
