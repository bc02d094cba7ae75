"""What the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.session import fresh_path

# A word is a run of anything but these; the regular expression holds for Java and Python.
WHITE_SPACE = r"[\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def words(text: Column) -> Column:
    """The words of a text; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WHITE_SPACE), lambda w: w != "")


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def remainder(doc_id: Column, divisor: int) -> Column:
    """The fold of a document: crc32 of its id as text, modulo ``divisor``."""
    return F.crc32(doc_id.cast("string")) % divisor


def staged(df: DataFrame, label: str) -> DataFrame:
    """Written to the shared folder and read again: computed once, lineage cut."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sampled(df: DataFrame, key: Column, rows: int, share: float | None = None) -> DataFrame:
    """About ``rows`` rows at most, chosen by a hash of the key: the same in every run."""
    total = df.count()
    if share is None:
        share = min(1.0, rows / max(total, 1))
    return df if share >= 1 else df.where(F.pmod(F.xxhash64(key), F.lit(1_000_003)) < int(share * 1_000_003))
