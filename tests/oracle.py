"""Compare Spark results with DuckDB on the same Parquet files."""

from __future__ import annotations

import datetime as dt
import glob
import os
from collections import Counter

import duckdb

TESTDATA = os.environ.get("TESTDATA", "/root/testdata")


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def plain(value):
    if isinstance(value, dt.datetime) and value.tzinfo is not None:
        return value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return value


def bag(columns, rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), Counter(tuple(plain(r[i]) for i in order) for r in rows)


def spark_bag(df):
    return bag(df.columns, [tuple(r) for r in df.collect()])


def duck_bag(con, sql):
    result = con.execute(sql)
    return bag([d[0] for d in result.description], result.fetchall())


# DuckDB type names as Spark calls them.
SAME_TYPE = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "VARCHAR": "string",
    "DOUBLE": "double",
    "BOOLEAN": "boolean",
    "DATE": "date",
    "TIMESTAMP": "timestamp",
    "DECIMAL(38,9)": "decimal(38,9)",
}


def duck_types(con, sql):
    rows = con.execute(f"describe {sql}").fetchall()
    return {r[0]: SAME_TYPE.get(r[1], r[1]) for r in rows}


def spark_types(df):
    return {n: t.replace("timestamp_ntz", "timestamp") for n, t in df.dtypes}
