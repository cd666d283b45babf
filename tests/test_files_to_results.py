"""From files in the published layouts to the results of the analyses."""

import pytest

from almanack import plans as P
from almanack import schemas
from almanack import sources as S

STATIONS = """\
USW00000001  44.8831  -93.2289  265.8 MN MINNEAPOLIS AIRPORT            GSN     72658
USW00000002  25.7906  -80.3164    8.8 FL MIAMI INTL AP                          72202
USW00000003  71.2833 -156.7814    9.4 AK BARROW AP                              70026
"""
MEASUREMENTS = """\
USW00000001,20180101,TMAX,-100,,,W,2400
USW00000001,20180101,TMIN,-200,,,W,2400
USW00000001,20180102,TMAX,0,,,W,2400
USW00000001,20180102,TMIN,-100,,,W,2400
USW00000002,20180101,TMAX,250,,,W,2400
USW00000002,20180101,TMIN,150,,,W,2400
USW00000002,20180101,PRCP,12,,,W,2400
USW00000003,20180101,TMAX,-150,,,W,2400
"""
WEATHER = """\
Day,doy,month,state,year,precip,snow,tave,tmax,tmin
1,1,1,MN,1999,0,0,10,20,0
2,2,1,MN,1999,1.5,T,20,30,10
3,3,1,MN,1999,M,0,30,30,30
4,4,1,MN,1999,2,0,.,99,1
"""
AREAS = """\
area_type_code\tarea_code\tarea_text\tdisplay_level
A\tST2700000000000\tMinnesota\t0
F\tCN2705300000000\tHennepin County, MN\t0
"""
SERIES = """\
series_id\tarea_type_code\tarea_code\tmeasure_code\tseasonal\tsrd_code\tseries_title
LAUST270000000000003          \tA\tST2700000000000\t03\tU\t27\tUnemployment Rate: Minnesota (U)
LAUCN270530000000003          \tF\tCN2705300000000\t03\tU\t27\tUnemployment Rate: Hennepin County, MN (U)
LAUCN270530000000004          \tF\tCN2705300000000\t04\tU\t27\tUnemployment: Hennepin County, MN (U)
"""
RATES = """\
series_id\tyear\tperiod\tvalue\tfootnote_codes
LAUST270000000000003          \t1989\tM01\t         4.0\t
LAUST270000000000003          \t1995\tM01\t         5.0\t
LAUST270000000000003          \t1996\tM13\t         3.0\t
LAUCN270530000000003          \t2016\tM10\t         3.1\t
LAUCN270530000000003          \t2016\tM11\t         3.3\tP
LAUCN270530000000004          \t2016\tM10\t     21000.0\t
"""
ZIPS = """\
zip_code,latitude,longitude,city,state,county
"55401",45.0,-93.0,"Minneapolis","MN","Hennepin"
"55402",44.0,-94.0,"Minneapolis","MN","Hennepin"
"55403",,,"Minneapolis","MN","Hennepin"
"00501",40.9,-72.6,"Holtsville","NY","Suffolk"
"96799",-14.2,-170.7,"Pago Pago","AS",""
"""


@pytest.fixture
def path(tmp_path):
    def write(text: str) -> str:
        file = tmp_path / f"{len(list(tmp_path.iterdir()))}.txt"
        file.write_text(text)
        return str(file)

    return write


def same_types(df, schema):
    return df.dtypes == [(f.name, f.dataType.simpleString()) for f in schema]


def test_station_temperature(spark, path):
    stations = S.read_stations(spark, path(STATIONS))
    measurements = S.read_measurements(spark, path(MEASUREMENTS))
    assert same_types(stations, schemas.STATION) and same_types(measurements, schemas.MEASUREMENT)
    places = stations.select("sid", "lat", "lon", "name")
    found = {r.sid: r for r in P.station_temperature(measurements, places).collect()}
    assert found.keys() == {"USW00000001", "USW00000002"}
    assert found["USW00000001"].tave == pytest.approx(14.0)
    assert found["USW00000002"].tave == pytest.approx(68.0)
    assert found["USW00000001"].name == "MINNEAPOLIS AIRPORT".ljust(30)


def test_daily_statistics(spark, path):
    days = S.read_daily_weather(spark, path(WEATHER))
    assert same_types(days, schemas.DAILY_WEATHER)
    row = P.daily_statistics(days).first()
    assert (row.hottest.day, row.rainy_days, row.rainy_tmax) == (2, 1, 30.0)
    assert row.rainy_percent == pytest.approx(100 / 3)


def test_best_decades(spark, path):
    rates = S.read_state_rates(spark, path(RATES))
    series, areas = S.read_series(spark, path(SERIES)), S.read_areas(spark, path(AREAS))
    assert same_types(rates, schemas.STATE_RATE)
    assert same_types(series, schemas.SERIES) and same_types(areas, schemas.AREA)
    found = P.best_decades_by_area(rates, series, areas)
    assert sorted(tuple(r) for r in found.collect()) == [
        (
            "CN2705300000000",
            "Hennepin County, MN",
            "Unemployment Rate: Hennepin County, MN (U)",
            2010,
            pytest.approx(3.2),
        ),
        ("ST2700000000000", "Minnesota", "Unemployment Rate: Minnesota (U)", 1980, 4.0),
    ]


def test_county_rates(spark, path):
    rates, zips = S.read_county_rates(spark, path(RATES)), S.read_zip_codes(spark, path(ZIPS))
    assert same_types(rates, schemas.COUNTY_RATE) and same_types(zips, schemas.ZIP_CODE)
    series = S.read_series(spark, path(SERIES))
    (row,) = P.county_rates_located(rates, series, zips, year=2016, period="M10").collect()
    assert tuple(row._1._1) == ("LAUCN270530000000003", 2016, "M10", 3.1)
    assert row._1._2.title == "Unemployment Rate: Hennepin County, MN (U)"
    assert tuple(row._2) == (44.5, -93.5, "MN", "Hennepin")
