"""Smoke checks of published tables and raw sources, with a code per kind of failure."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.sources.registry import RawSource, read_raw
from stratiform.storage import matches

# Result codes.
OK, NOT_FOUND, TOO_FEW_ROWS, FORBIDDEN, UNREADABLE, UNEXPECTED = 0, 2, 3, 3, 4, 99


@dataclass(frozen=True)
class SmokeResult:
    code: int
    message: str
    table_type: str | None = None
    columns: int = 0
    rows: int | None = None
    sample: list = field(default_factory=list)

    @property
    def ok(self) -> bool:
        return self.code == OK


def smoke_frame(df: DataFrame, table: str, min_rows: int = 1) -> DataFrame:
    """The check as one row; for Parquet the count comes from file footers alone."""
    rows = F.count(F.lit(1))
    return df.agg(
        F.lit(table).alias("table_name"),
        F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
        rows.alias("n_rows"),
        (rows >= min_rows).alias("passed"),
    )


def smoke_check(
    spark: SparkSession, table: str, *, min_rows: int = 1, limit: int = 5
) -> SmokeResult:
    """Does the table exist, has it at least ``min_rows`` rows, can some be read."""
    if not spark.catalog.tableExists(table):
        return SmokeResult(NOT_FOUND, f"table not found: {table}")
    kind = spark.catalog.getTable(table).tableType
    df = spark.table(table)
    rows = smoke_frame(df, table, min_rows).first()["n_rows"]
    width = len(df.columns)
    if rows < min_rows:
        return SmokeResult(TOO_FEW_ROWS, f"{rows} rows, expected {min_rows}", kind, width, rows)
    return SmokeResult(OK, "ok", kind, width, rows, df.limit(limit).collect())


def smoke_check_source(spark: SparkSession, source: RawSource, *, limit: int = 5) -> SmokeResult:
    """Are the source's files there, and can ``limit`` rows of them be read."""
    try:
        if not any(matches(spark, uri) for uri in source.uris):
            return SmokeResult(NOT_FOUND, f"no files for source {source.name}")
        df = read_raw(spark, source)
        sample = df.limit(limit).collect()
    except Exception as err:  # a smoke check reports, it does not raise
        return SmokeResult(_code_of(err), f"{source.name}: {err}")
    return SmokeResult(OK, "ok", "EXTERNAL", len(df.columns), None, sample)


def _code_of(err: Exception) -> int:
    text = str(err)
    if "AccessControlException" in text or "ermission denied" in text or "AccessDenied" in text:
        return FORBIDDEN
    if "PATH_NOT_FOUND" in text or "FileNotFoundException" in text:
        return NOT_FOUND
    unreadable = ("UNABLE_TO_INFER_SCHEMA", "CANNOT_READ", "PARQUET_TYPE", "FAILED_READ_FILE")
    if any(mark in text for mark in unreadable) or "not a Parquet file" in text:
        return UNREADABLE
    return UNEXPECTED
