"""Compare a Spark result with SQL over the same tables, order aside."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


SQL_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def spark_rows(df):
    order = sorted(df.columns)
    return order, Counter(tuple(r[c] for c in order) for r in df.collect())


def sql_rows(con, sql: str):
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    order = sorted(names)
    at = [names.index(c) for c in order]
    return order, Counter(tuple(r[i] for i in at) for r in cursor.fetchall())


def difference(df, con, sql: str) -> str | None:
    """None if the results agree, else what differs."""
    spark_types = {name: SQL_TYPES.get(dtype, dtype) for name, dtype in df.dtypes}
    sql_types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    if spark_types != sql_types:
        return f"types {spark_types} and {sql_types}"
    spark_columns, ours = spark_rows(df)
    sql_columns, theirs = sql_rows(con, sql)
    if spark_columns != sql_columns:
        return f"columns {spark_columns} and {sql_columns}"
    if ours != theirs:
        only_ours, only_theirs = list((ours - theirs).items()), list((theirs - ours).items())
        return (
            f"{ours.total()} and {theirs.total()} rows, {len(only_ours)} only in Spark:"
            f" {only_ours[:2]}, {len(only_theirs)} only in SQL: {only_theirs[:2]}"
        )
    return None
