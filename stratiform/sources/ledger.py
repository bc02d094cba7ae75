"""Which files of a source have been loaded, so that a run finds those that came since.

A ledger is a table of path, length and time of change. Files are listed by Spark, without
opening them; what the ledger lacks is new, as is a file that was replaced under its name.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.sinks import append_table, publish_table
from stratiform.sources.registry import RawSource, read_raw


def listed(spark: SparkSession, source: RawSource) -> DataFrame:
    """The files of a source as they are now."""
    reader = spark.read.format("binaryFile")
    if source.base_path:
        reader = reader.option("basePath", source.base_path)
    return reader.load(list(source.uris)).select(
        "path", "length", F.col("modificationTime").alias("modified")
    )


def unloaded(spark: SparkSession, files: DataFrame, ledger: str) -> DataFrame:
    """Files that the ledger does not have; all of them without a ledger."""
    if not spark.catalog.tableExists(ledger):
        return files
    return files.join(spark.table(ledger), ["path", "length", "modified"], "left_anti")


def record(files: DataFrame, ledger: str) -> None:
    """Note files as loaded. Do it last: a run that dies before does its work once more."""
    if files.sparkSession.catalog.tableExists(ledger):
        append_table(files, ledger)
    else:
        publish_table(files, ledger, comment="Files that the daily fact has taken in.")


def read_files(spark: SparkSession, source: RawSource, files: DataFrame) -> DataFrame | None:
    """The rows of some files of a source; None without any.

    Spark takes paths as a list, so those of one run's new files come to the driver.
    """
    paths = [row["path"] for row in files.select("path").collect()]
    return read_raw(spark, replace(source, uris=tuple(paths))) if paths else None
