"""Files with a header or a fixed column order, and sinks of part files."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    *,
    header: bool = False,
    sep: str = ",",
    date_format: str | None = None,
    trim: bool = False,
    mode: str = "PERMISSIVE",
    strict: bool | None = None,
) -> DataFrame:
    """Read a delimited file whose columns match ``schema`` by position.

    Columns beyond the schema are ignored. ``mode`` is Spark's: ``PERMISSIVE``
    turns a bad cell into NULL, ``FAILFAST`` raises, also for more columns than
    the schema has. ``strict`` decides about cells only: if true, one that does not
    fit its type raises (in ANSI mode, Spark's default); if false, it becomes NULL
    and the row is marked in a further column ``bad_row``.
    """
    kinds = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    texts = StructType([StructField(f.name, StringType()) for f in kinds])
    reader = (
        spark.read.schema(kinds if strict is None else texts)
        .option("header", header)
        .option("sep", sep)
        .option("mode", mode)
        .option("ignoreLeadingWhiteSpace", trim)
        .option("ignoreTrailingWhiteSpace", trim)
    )
    if date_format:
        reader = reader.option("dateFormat", date_format)
    rows = reader.csv(path)
    return rows if strict is None else _typed(rows, kinds, date_format, strict)


def _typed(rows: DataFrame, kinds: StructType, date_format: str | None, strict: bool) -> DataFrame:
    """Text columns as their types; ``bad_row`` where one was no such value, unless strict."""
    values, bad = [], F.lit(False)
    for field in kinds:
        text, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, DateType) and date_format:
            pattern = F.lit(date_format)
            value = F.to_date(text, date_format) if strict else F.try_to_timestamp(text, pattern)
            value = value.cast(kind)
        else:
            value = text.cast(kind) if strict else text.try_cast(kind)
        values.append(value.alias(field.name))
        bad = bad | (text.isNotNull() & value.isNull())
    return rows.select(*values) if strict else rows.select(*values, bad.alias("bad_row"))


def read_csv_cast(
    spark: SparkSession,
    path: str,
    casts: Mapping[str, str],
    *,
    drop: Iterable[str] = (),
    sep: str = ",",
    trim: bool = False,
    strict: bool = True,
) -> DataFrame:
    """Read a file by the names in its header, all text, then cast some columns.

    A value that does not fit its type raises when ``strict`` (in Spark's ANSI
    mode) and becomes NULL otherwise.
    """
    raw = (
        spark.read.option("header", True)
        .option("sep", sep)
        .option("ignoreLeadingWhiteSpace", trim)
        .option("ignoreTrailingWhiteSpace", trim)
        .csv(path)
    )
    typed = {
        name: F.col(name).cast(dtype) if strict else F.col(name).try_cast(dtype)
        for name, dtype in casts.items()
    }
    return raw.drop(*drop).withColumns(typed)


def write_json(df: DataFrame, path: str) -> None:
    """Write one JSON object per line, as one part file per task."""
    df.write.json(path)


def write_lines(df: DataFrame, path: str, sep: str = ", ") -> None:
    """Write each row as one line of its values, as one part file per task."""
    values = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in df.columns]
    df.select(F.concat_ws(sep, *values).alias("value")).write.text(path)
