import datetime as dt

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from almanack import schemas
from almanack import sources as S
from almanack.session import fresh_folder, require_shared, staging_path
from almanack.sources.records import STATION_SLICES, WEATHER_FIELDS

def rows(df):
    return [tuple(r) for r in df.collect()]


def test_csv_by_position_with_padding(spark, tmp_path):
    path = tmp_path / "store.csv"
    path.write_text("storeid,channel,country\r\n7,Digital,OMAN   \r\n8, Store,PERU\r\n")
    trimmed = S.read_csv(spark, str(path), schemas.STORE, header=True, trim=True)
    assert rows(trimmed) == [(7, "Digital", "OMAN"), (8, "Store", "PERU")]
    kept = S.read_csv(spark, str(path), schemas.STORE, header=True)
    assert rows(kept) == [(7, "Digital", "OMAN   "), (8, " Store", "PERU")]


def test_csv_bad_cell_is_null_or_raises(spark, tmp_path):
    path = tmp_path / "store.csv"
    path.write_text("x,Digital,OMAN\n")
    assert rows(S.read_csv(spark, str(path), schemas.STORE)) == [(None, "Digital", "OMAN")]
    with pytest.raises((PySparkException, Py4JJavaError)):
        S.read_csv(spark, str(path), schemas.STORE, mode="FAILFAST").collect()


def test_csv_dates_and_columns_beyond_the_schema(spark, tmp_path):
    path = tmp_path / "2018.csv"
    path.write_text("S1,20180102,TMAX,15,,,E,\nS1,20180103,TMIN,   5.3,,,E,\n")
    read = S.read_csv(spark, str(path), schemas.MEASUREMENT, date_format="yyyyMMdd")
    assert rows(read) == [
        ("S1", dt.date(2018, 1, 2), "TMAX", 15.0),
        ("S1", dt.date(2018, 1, 3), "TMIN", 5.3),
    ]


@pytest.mark.parametrize(
    ("read", "head", "good", "bad"),
    [
        (S.read_sales, "h", "1,2.5,3,4,5,6", "1,2.5,3,x,5,6"),
        (S.read_calendar, "h", "1,2,2018,3", "1,2,y,3"),
        (S.read_stores, "h", "1,Store,SPAIN", "one,Store,SPAIN"),
        (S.read_products, "h", "1,A,B,C", "1.5x,A,B,C"),
        (S.read_county_rates, "h", "A\t2001\tM01\t2.5\tmore", "A\tyear\tM01\t2.5"),
        (S.read_zip_codes, "h", "1,2.5,3.5,a,b,c", "1,north,3.5,a,b,c"),
        (S.read_measurements, None, "S1,20180102,TMAX,15,,,E", "S1,2018-13-02,TMAX,15"),
    ],
)
def test_readers_are_strict_or_mark_the_row(spark, tmp_path, read, head, good, bad):
    path = tmp_path / "records"
    path.write_text("\n".join([*([head] if head else []), good, bad]) + "\n")
    with pytest.raises(PySparkException):
        read(spark, str(path)).collect()
    found = read(spark, str(path), strict=False)
    assert found.columns[-1] == "bad_row"
    assert [r.bad_row for r in found.collect()] == [False, True]
    path.write_text("\n".join([*([head] if head else []), good]) + "\n")
    assert read(spark, str(path)).columns == found.columns[:-1]
    assert None not in read(spark, str(path)).first()


def test_csv_with_named_casts(spark, tmp_path):
    path = tmp_path / "sales.csv"
    path.write_text("saleId,netSales,productId\n1,300.24,00567228914507\n2,oops,5\n")
    casts = {"netSales": "double", "productId": "bigint"}
    lenient = S.read_csv_cast(spark, str(path), casts, drop=["saleId"], strict=False)
    assert lenient.columns == ["netSales", "productId"]
    assert rows(lenient) == [(300.24, 567228914507), (None, 5)]
    with pytest.raises(PySparkException):
        S.read_csv_cast(spark, str(path), casts).collect()


def test_fixed_width(lines):
    line = "USC00012345  44.9778  -93.2650  252.4    MINNEAPOLIS                   extra"
    (row,) = rows(S.parse_fixed_width(lines(line), STATION_SLICES))
    assert row == ("USC00012345", 44.9778, -93.265, 252.4, "MINNEAPOLIS".ljust(30))


def test_fixed_width_strict_and_lenient(lines):
    text = lines("USC00012345  north    -93.2650  252.4    NOWHERE")
    with pytest.raises(PySparkException):
        S.parse_fixed_width(text, STATION_SLICES).collect()
    (row,) = S.parse_fixed_width(text, STATION_SLICES, strict=False).collect()
    assert (row.lat, row.lon, row.bad_row) == (None, -93.265, True)


def test_delimited_drops_every_line_with_the_token(lines):
    text = lines("series_id\tyear", "  A1 \t1999", "B\t2000", "mid-year\t2001")
    fields = [S.Field("id", 0), S.Field("n", 1, "int")]
    found = S.parse_delimited(text, fields, sep="\t", header_token="year")
    assert rows(found) == [("A1", 1999), ("B", 2000)]


def test_delimited_skip_and_no_trim(lines):
    fields = [S.Field("period", 0, "int", skip=1), S.Field("text", 1)]
    assert rows(S.parse_delimited(lines("M07, x "), fields, trim=False)) == [(7, " x ")]


@pytest.mark.parametrize("sep", [",", "\t", "|", ".", ";;", "a+"])
def test_delimited_separator_is_a_literal(lines, sep):
    text = lines(sep.join(["1", "2", "3"]))
    assert rows(S.parse_delimited(text, [S.Field("n", 2, "int")], sep=sep)) == [(3,)]


def test_delimited_short_line(lines):
    text, fields = lines("1,2", "3"), [S.Field("a", 0, "int"), S.Field("b", 1, "int")]
    with pytest.raises(PySparkException):
        S.parse_delimited(text, fields).collect()
    found = S.parse_delimited(text, fields, strict=False)
    assert rows(found) == [(1, 2, False), (3, None, True)]


def test_missing_markers_and_numbers_with_a_default(lines):
    text = lines(
        "Day,doy,month,state,year,precip,snow,tave,tmax,tmin",
        "1,1,1,MN,1999,0.5,0,20,30,10",
        "2,2,1,MN,1999,T,,20,30,10",
        "3,3,1,MN,1999,0.5,0,.,30,10",
        "4,4,1,MN,1999,0.5,0,20,.,10",
        "5,5,1,MN,1999,0.5,0,20,30,.",
        "6,6,1,MN,1999,.,M,20,30,10",
    )
    found = S.parse_delimited(text, WEATHER_FIELDS, header_token="Day", missing=(".", [7, 8, 9]))
    assert found.dtypes == [(f.name, f.dataType.simpleString()) for f in schemas.DAILY_WEATHER]
    assert [(r.day, r.precip, r.snow) for r in found.collect()] == [
        (1, 0.5, 0.0),
        (2, -1.0, -1.0),
        (6, -1.0, -1.0),
    ]


def test_only_used_fields_are_cut_out(lines):
    found = S.parse_delimited(lines("1,x"), [S.Field("a", 0, "int"), S.Field("b", 1, "int")])
    assert rows(found.select("a")) == [(1,)]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 2.5), (2, None, 3.0)], "n int, s string, x double")
    S.write_json(df, str(tmp_path / "json"))
    back = spark.read.schema(df.schema).json(str(tmp_path / "json"))
    assert sorted(rows(back)) == [(1, "a", 2.5), (2, None, 3.0)]
    S.write_lines(df, str(tmp_path / "text"))
    text = spark.read.text(str(tmp_path / "text"))
    assert sorted(r.value for r in text.collect()) == ["1, a, 2.5", "2, null, 3.0"]


def test_staging_is_in_the_shared_folder():
    cluster = {"spark.master": "yarn", "spark.checkpoint.dir": "/shared/folder/"}
    one, two = fresh_folder(cluster), fresh_folder(cluster)
    assert one.startswith("/shared/folder/almanack-") and one != two
    unset = {"spark.sql.warehouse.dir": "file:/warehouse"}
    assert fresh_folder(unset).startswith("file:/warehouse/almanack-")


def test_staged_files_have_a_folder_of_their_own(spark):
    one, two = staging_path(spark, "x"), staging_path(spark, "x")
    assert one != two
    spark.range(3).write.csv(one)
    assert spark.read.csv(one).count() == 3


def test_a_local_warehouse_is_refused_on_a_cluster():
    require_shared("file:/warehouse/x", "local[8]")
    require_shared("hdfs://name/warehouse/x", "yarn")
    with pytest.raises(ValueError, match="checkpoint"):
        require_shared("file:/warehouse/x", "spark://host:7077")
