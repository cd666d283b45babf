import pytest

from almanack import plans as P
from almanack.schemas import DAILY_WEATHER

DAYS = [
    # day, doy, month, year, precip, snow, tave, tmax, tmin
    (2, 2, 1, 1999, 0.0, 0.0, 10.0, 20.0, 0.0),
    (1, 32, 2, 1999, 1.0, -1.0, 20.0, 40.0, 2.0),
    (2, 33, 2, 1999, 3.0, 0.0, 30.0, 30.0, 4.0),
    (1, 32, 2, 1998, -1.0, 0.0, 40.0, 40.0, 6.0),
]


@pytest.fixture
def days(spark):
    return spark.createDataFrame(DAYS, DAILY_WEATHER).repartition(3)


def test_hottest_days_are_all_of_them(days):
    assert sorted(r.year for r in P.hottest_days(days).collect()) == [1998, 1999]


def test_daily_statistics(days):
    row = P.daily_statistics(days).first()
    assert tuple(row.hottest) == DAYS[3]
    assert (row.rainy_days, row.rainy_percent, row.rainy_tmax) == (2, 50.0, 35.0)
    assert row.tmax_std == pytest.approx(68.75**0.5)
    assert row.tmin_std == pytest.approx(5**0.5)
    assert row.tave_std == pytest.approx(125**0.5)


def test_no_rain_and_no_days(days):
    assert P.daily_statistics(days, rainy=99).first().rainy_tmax is None
    assert P.daily_statistics(days.limit(0)).first().hottest is None


def test_monthly_averages_in_order(days):
    found = P.monthly_averages(days).collect()
    assert [tuple(r) for r in found] == [
        (1, 20.0, 0.0),
        (2, pytest.approx(110 / 3), pytest.approx(4.0)),
    ]


def test_yearly_sums_in_order(days):
    found = P.yearly_sums(days).collect()
    assert [tuple(r) for r in found] == [(1998, 40.0, 1, 40.0), (1999, 90.0, 3, 30.0)]
