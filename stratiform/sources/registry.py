"""Raw sources by name: where their files are and how to read them."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.config import OPTIONAL_SOURCES, EnvConfig
from stratiform.sources.readers import read_partitioned

# Source format names and the Spark readers behind them.
FORMATS = {
    "PARQUET": "parquet",
    "CSV": "csv",
    "NEWLINE_DELIMITED_JSON": "json",
    "AVRO": "avro",
    "ICEBERG": "iceberg",
}


class SourceFormatUnavailable(RuntimeError):
    """The reader for a declared format is not on the session's classpath."""


@dataclass(frozen=True)
class RawSource:
    """One external dataset.

    ``base_path`` turns ``key=value`` folders below it into columns. ``schema``
    (DDL) saves CSV and JSON the extra pass over the files that inferring takes,
    so give it for anything large. ``nanos`` lists INT64 nanosecond timestamp
    columns of Parquet files.
    """

    name: str
    uris: tuple[str, ...]
    format: str = "PARQUET"
    autodetect: bool = True
    base_path: str | None = None
    schema: str | None = None
    require_partition_filter: bool = False
    nanos: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if self.format not in FORMATS:
            raise ValueError(f"unknown format {self.format!r}, expected one of {sorted(FORMATS)}")
        if not self.uris:
            raise ValueError(f"source {self.name!r} has no uris")
        if self.format == "CSV" and not (self.schema or self.autodetect):
            raise ValueError(f"source {self.name!r}: give a schema or allow autodetect")


def enabled_sources(cfg: EnvConfig) -> tuple[RawSource, ...]:
    """The declared sources without the optional ones, unless those are enabled."""
    if cfg.enable_sales_orders:
        return tuple(cfg.sources)
    return tuple(s for s in cfg.sources if s.name not in OPTIONAL_SOURCES)


def read_raw(spark: SparkSession, source: RawSource, where: Column | None = None) -> DataFrame:
    """Lazy scan of a source; the schema comes from the files unless it is given.

    A source that requires a partition filter is only read with a ``where`` that names
    some of its ``key=value`` folders.
    """
    df = _scan(spark, source)
    if where is None and not source.require_partition_filter:
        return df
    return read_partitioned(spark, df, where, require_filter=source.require_partition_filter)


def _scan(spark: SparkSession, source: RawSource) -> DataFrame:
    reader = spark.read.format(FORMATS[source.format])
    if source.base_path:
        reader = reader.option("basePath", source.base_path)
    if source.format == "CSV":
        reader = reader.option("header", True)
        if source.schema is None:
            reader = reader.option("inferSchema", True)
    if source.schema is not None:
        reader = reader.schema(source.schema)
    if source.nanos:
        # Without this Spark refuses the whole file. It holds for the session: later reads
        # take undeclared columns of that kind as whole numbers, too.
        spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
    try:
        df = reader.load(list(source.uris))
    except Exception as err:
        if _reader_is_missing(err):
            raise SourceFormatUnavailable(
                f"source {source.name!r} is {source.format}: add its Spark package to the session"
            ) from err
        raise
    return df.withColumns({c: nanos_to_timestamp(c) for c in source.nanos})


def nanos_to_timestamp(column: str) -> Column:
    """Whole microseconds, rounded down, in integers: a double would lose digits."""
    return F.timestamp_micros(F.expr(f"`{column}` div 1000 - if(`{column}` % 1000 < 0, 1, 0)"))


def _reader_is_missing(err: Exception) -> bool:
    text = str(err)
    if isinstance(err, AnalysisException) and "AVRO" in text.upper():
        return "Failed to find data source" in text or "is built-in but external" in text
    return "DATA_SOURCE_NOT_FOUND" in text or "Failed to find the data source" in text


def source_named(sources: Iterable[RawSource], name: str) -> RawSource:
    for source in sources:
        if source.name == name:
            return source
    raise KeyError(f"no source named {name!r}")
