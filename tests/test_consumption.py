"""Weekly consumption and the weekly report on a small star of CSV files."""

import json

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from almanack import plans as P
from almanack import schemas
from almanack import sources as S
from plans_text import plan

SALES_CSV = """saleId,netSales,salesUnits,storeId,dateId,productId
1,100.10,1,7,100,00000000000042
2,200.20,2,7,101,00000000000042
3,0.10,1,7,102,00000000000042
4,50.00,5,8,100,00000000000042
5,60.00,6,9,100,00000000000042
6,70.07,7,9,200,00000000000043
"""
CALENDAR_CSV = """datekey,datecalendarday,datecalendaryear,weeknumberofseason
100,1,2018,2
101,2,2018,2
102,92,2018,2
200,3,2001,13
"""
STORE_CSV = """storeid,channel,country
7,Digital,OMAN
8,Digital,PERU
9,Store,PERU
"""
# The padding is kept by a reader without trim.
PRODUCT_CSV = """productid,division,gender,category
00000000000042,APPAREL,KIDS, SPINE
00000000000043,APPAREL,MENS,HOCKEY
"""


@pytest.fixture
def star(spark, tmp_path):
    tables = []
    for name, text, schema in [
        ("sales", SALES_CSV, schemas.SALES),
        ("calendar", CALENDAR_CSV, schemas.CALENDAR),
        ("store", STORE_CSV, schemas.STORE),
        ("product", PRODUCT_CSV, schemas.PRODUCT),
    ]:
        path = tmp_path / f"{name}.csv"
        path.write_text(text.replace("\n", "\r\n") if name != "sales" else text)
        tables.append(S.read_csv(spark, str(path), schema, header=True, trim=True))
    return tables


# One row per week, store and product, so the id of the two stores in Peru repeats.
EXPECTED = [
    ("Y18_W2_OMAN_APPAREL_KIDS_SPINE", 4, 300.4),
    ("Y18_W2_PERU_APPAREL_KIDS_SPINE", 5, 50.0),
    ("Y18_W2_PERU_APPAREL_KIDS_SPINE", 6, 60.0),
    ("Y1_W13_PERU_APPAREL_MENS_HOCKEY", 7, 70.07),
]


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_golden(star):
    found = P.weekly_consumption(*star)
    assert rows(found) == EXPECTED
    assert found.dtypes == [(f.name, f.dataType.simpleString()) for f in schemas.CONSUMPTION]


def test_sql_form_agrees(spark, star):
    found = P.weekly_consumption_sql(spark, *star)
    assert rows(found) == EXPECTED
    assert found.dtypes == [(f.name, f.dataType.simpleString()) for f in schemas.CONSUMPTION]


def test_partitions_and_broadcasts_do_not_change_the_result(star):
    sales, calendar, store, product = star
    spread = [sales.repartition(5), calendar.repartition(2), store.repartition(3), product]
    assert rows(P.weekly_consumption(*spread, max_broadcast_bytes=0)) == EXPECTED


def test_sales_without_a_match_are_left_out(star):
    sales, calendar, store, product = star
    found = P.weekly_consumption(sales, calendar, store.filter("store_id = 7"), product)
    assert rows(found) == EXPECTED[:1]


def test_unknown_week_and_unknown_year_share_the_null_key(spark, star):
    sales, calendar, _, _ = star
    holes = calendar.withColumns(
        {
            "date_year": F.when(F.col("date_id") != 100, F.col("date_year")),
            "week_number": F.when(F.col("date_id") != 101, F.col("week_number")),
        }
    )
    two_days = sales.filter("store_id = 7 and date_id < 102")
    assert rows(P.weekly_sales(two_days, holes)) == [(None, 7, 42, 3, 300.3)]
    by_sql = P.weekly_consumption_sql(spark, two_days, holes, *star[2:])
    assert rows(by_sql) == [(None, 3, 300.3)]


def test_week_keys_without_a_thousand_years(star):
    """Years that are the same modulo 1000 have one key, hence one sum."""
    sales, calendar, _, _ = star
    moved = calendar.withColumn(
        "date_year", F.when(F.col("date_id") == 101, 1018).otherwise(F.col("date_year"))
    )
    found = P.weekly_sales(sales.filter("store_id = 7"), moved)
    assert rows(found) == [("Y18_W2", 7, 42, 4, 300.4)]


def test_report_fills_missing_weeks_with_zero(star):
    report = P.weekly_report(*star)
    weeks = [f"W{n}" for n in range(1, 53)]
    assert report.columns == [
        "unique_key", "year", "channel", "division", "gender", "category", "row_id", *weeks, "W_other"
    ]
    by_key = {(r.unique_key, r.row_id): r for r in report.collect()}
    assert len(by_key) == 6
    digital = by_key["RY18_DIGITAL_APPAREL_KIDS_SPINE", "Net Sales"]
    assert [digital[w] for w in weeks] == [0.0, 350.4] + [0.0] * 50
    units = by_key["RY18_STORE_APPAREL_KIDS_SPINE", "Sales Units"]
    assert (units.W2, units.W13) == (6.0, 0.0)
    assert by_key["RY1_STORE_APPAREL_MENS_HOCKEY", "Net Sales"].W13 == 70.07


def test_report_keeps_every_sale(star):
    report = P.weekly_report(*star)
    total = sum((F.col(f"W{n}") for n in range(1, 53)), F.col("W_other"))
    sums = dict(rows(report.groupBy("row_id").agg(F.sum(total))))
    assert sums == {"Net Sales": pytest.approx(480.47), "Sales Units": 22.0}


def test_report_gathers_other_weeks(star):
    sales, calendar, *dimensions = star
    unknown = F.when(F.col("week_number") != 13, F.col("week_number"))
    for days, weeks in ((calendar, 12), (calendar.withColumn("week_number", unknown), 52)):
        report = P.weekly_report(sales, days, *dimensions, weeks=weeks)
        found = {(r.unique_key, r.row_id): r for r in report.collect()}
        assert found["RY1_STORE_APPAREL_MENS_HOCKEY", "Net Sales"].W_other == 70.07
        assert found["RY18_DIGITAL_APPAREL_KIDS_SPINE", "Net Sales"].W_other == 0.0


def test_report_sums_the_sales_before_they_meet_a_dimension(star, settings):
    off = {"spark__sql__autoBroadcastJoinThreshold": -1}
    off["spark__sql__adaptive__autoBroadcastJoinThreshold"] = -1
    with settings(**off):
        text = plan(P.weekly_report(*star, max_broadcast_bytes=0))
    # In the plan's text a step stands above what it is made from.
    first_sum = text.rindex("partial_sum(net_sales")
    assert text.index("Join [store_id") < first_sum and text.index("Join [product_id") < first_sum


def test_report_documents(star):
    found = P.weekly_report_json(*star).collect()
    documents = {d["uniqueKey"]: d for d in (json.loads(r.value) for r in found)}
    assert len(documents) == 3
    one = documents["RY18_DIGITAL_APPAREL_KIDS_SPINE"]
    assert list(one) == [
        "uniqueKey", "division", "gender", "category", "channel", "year", "dataRows"
    ]
    assert (one["channel"], one["year"]) == ("DIGITAL", "RY18")
    assert [r["rowId"] for r in one["dataRows"]] == ["Net Sales", "Sales Units"]
    assert list(one["dataRows"][0]["dataRow"]) == [*(f"W{n}" for n in range(1, 53)), "W_other"]
    assert one["dataRows"][1]["dataRow"]["W2"] == 9.0
