import pytest

from almanack import plans as P
from almanack import schemas

DATA = [
    # Two decades; the yearly summary period 13 counts like any other.
    ("LAUCN01003", 1995, 1, 4.0),
    ("LAUCN01003", 1999, 13, 8.0),
    ("LAUCN01003", 2000, 1, 5.0),
    # A tie goes to the earlier decade.
    ("LAUCN02003", 2005, 1, 3.0),
    ("LAUCN02003", 1985, 1, 3.0),
    # Not a rate.
    ("LAUCN01004", 1995, 1, 99.0),
    # Without a series; without an area.
    ("LAUCN03003", 1995, 1, 1.0),
    ("LAUCN04003", 1995, 1, 1.0),
]
SERIES = [
    ("LAUCN01003", "CN010", "03", "Rate: One"),
    ("LAUCN02003", "CN020", "03", "Rate: Two"),
    ("LAUCN04003", "CN040", "03", "Rate: Four"),
]
AREAS = [("CN010", "Area one"), ("CN020", "Area two"), ("CN030", "Area three")]


@pytest.fixture
def labour(spark):
    return (
        spark.createDataFrame(DATA, schemas.STATE_RATE),
        spark.createDataFrame(SERIES, schemas.SERIES),
        spark.createDataFrame(AREAS, schemas.AREA),
    )


def test_best_decades(labour):
    found = P.best_decades(labour[0])
    assert sorted(tuple(r) for r in found.collect()) == [
        ("LAUCN01003", 1990, 6.0),
        ("LAUCN02003", 1980, 3.0),
        ("LAUCN03003", 1990, 1.0),
        ("LAUCN04003", 1990, 1.0),
    ]


def test_best_decades_by_area(labour):
    found = P.best_decades_by_area(*labour)
    assert sorted(tuple(r) for r in found.collect()) == [
        ("CN010", "Area one", "Rate: One", 1990, 6.0),
        ("CN020", "Area two", "Rate: Two", 1980, 3.0),
    ]


RATES = [
    ("LAUCN1703103   ", 2016, "M10", 5.5),
    ("LAUCN2703103   ", 2016, "M10", 4.5),
    ("LAUCN1703103   ", 2016, "M09", 9.9),
    ("LAUCN1703103   ", 2015, "M10", 9.9),
    ("LAUCN1703104   ", 2016, "M10", 9.9),
]
TITLES = [
    # A header line that was not dropped is a series that no rate has.
    ("series_id", "area_code", "measure_code", "series_title"),
    ("LAUCN1703103", "CN17031", "03", "Unemployment Rate: Cook County, IL (U)"),
    ("LAUCN2703103", "CN27031", "03", "Unemployment Rate: Cook County, MN (U)"),
    ("LAUCN1703104", "CN17031", "04", "Unemployment: Cook County, IL (U)"),
]
ZIPS = [
    ("1", 10.0, -10.0, "a", "IL", "Cook"),
    ("2", 20.0, -30.0, "b", "IL", "Cook"),
    ("3", None, -99.0, "c", "IL", "Cook"),
    ("4", 40.0, -40.0, "d", "MN", "Cook"),
    ("5", 50.0, -50.0, "e", "MN", None),
    ("6", 60.0, -60.0, "f", "IL", "Coo"),
    ("7", 70.0, -70.0, "g", "IL", "Lake"),
]


def test_county_rates_located(spark):
    found = P.county_rates_located(
        spark.createDataFrame(RATES, schemas.COUNTY_RATE),
        spark.createDataFrame(TITLES, schemas.SERIES),
        spark.createDataFrame(ZIPS, schemas.ZIP_CODE),
        year=2016,
        period="M10",
    )
    assert found.columns == ["_1", "_2"]
    assert found.select("_1.*").columns == ["_1", "_2"]
    assert found.select("_1._1.*").columns == schemas.COUNTY_RATE.names
    assert found.select("_1._2.*").columns == schemas.SERIES.names
    assert found.select("_2.*").columns == schemas.COUNTY_LOCATION.names
    rows = sorted((r._1._1.id, r._1._1.value, *r._2) for r in found.collect())
    assert rows == [
        ("LAUCN1703103", 5.5, 15.0, -20.0, "IL", "Cook"),
        ("LAUCN1703103", 5.5, 60.0, -60.0, "IL", "Coo"),
        ("LAUCN2703103", 4.5, 40.0, -40.0, "MN", "Cook"),
    ]
