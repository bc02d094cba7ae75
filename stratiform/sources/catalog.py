"""Raw sources as tables of the session catalog, for every session that shares it.

A source becomes an external table: the catalog knows its files, format and schema, and
dropping it removes no file. Folders ``key=value`` become partitions, each added with its place,
so only those that the source names count and a query on them lists only what it needs. A
source that wants a partition filter says so as a property of the table (see the readers).

A source of several locations is a view over one table for each. Files that land later in the
same folders are found by the next run, or by :func:`declare_raw` again.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.config import EnvConfig
from stratiform.functions.casts import quoted
from stratiform.sources.readers import GUARD, guarded
from stratiform.sources.registry import FORMATS, RawSource, enabled_sources, read_raw
from stratiform.storage import partition_locations, partition_schema, table_properties

# What a table was declared from; another definition replaces it.
_DEFINITION = "stratiform.source"
_AT_ONCE = 500


def raw_name(cfg: EnvConfig, source: RawSource) -> str:
    """Raw tables are plain files, so they live in the session catalog whatever ``cfg.catalog``."""
    return f"{cfg.namespace('raw_ext')}.{source.name}"


def declare_sources(spark: SparkSession, cfg: EnvConfig) -> list[str]:
    """Declare each enabled source; returns the names of the tables."""
    return [declare_raw(spark, source, raw_name(cfg, source)) for source in enabled_sources(cfg)]


def declare_raw(spark: SparkSession, source: RawSource, name: str) -> str:
    """Make a source the table ``name``, or bring the table up to date with its files."""
    if source.nanos:
        raise ValueError(f"source {source.name!r}: nanoseconds are read by read_raw only")
    namespace = name.rsplit(".", 1)[0]
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {namespace}")
    if len(source.uris) == 1:
        _declare(spark, source, source.uris[0], name)
        return name
    parts = [f"{name}__{k + 1}" for k in range(len(source.uris))]
    for part, uri in zip(parts, source.uris):
        _declare(spark, source, uri, part)
    columns = ", ".join(map(quoted, spark.table(parts[0]).columns))
    union = " UNION ALL ".join(f"SELECT {columns} FROM {part}" for part in parts)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {union}")
    return name


def read_declared(spark: SparkSession, cfg: EnvConfig, source: RawSource) -> DataFrame:
    """A source by way of its table, which is declared or brought up to date first.

    Sources with nanoseconds have no table and are read from their files.
    """
    if source.nanos:
        return read_raw(spark, source)
    return guarded(spark.table(declare_raw(spark, source, raw_name(cfg, source))))


def _declare(spark: SparkSession, source: RawSource, uri: str, name: str) -> None:
    scan = read_raw(spark, _one(source, uri))
    partitions = partition_schema(scan)
    definition = f"{source.format} {uri} {source.base_path or ''} {scan.schema.simpleString()}"
    if spark.catalog.tableExists(name):
        if table_properties(spark, name).get(_DEFINITION) != definition:
            spark.sql(f"DROP TABLE {name}")  # external: the files stay
    if not spark.catalog.tableExists(name):
        _create(spark, source, uri, name, scan, partitions, definition)
    if partitions:
        _add_partitions(spark, name, scan, partitions)
    spark.catalog.refreshTable(name)


def _one(source: RawSource, uri: str) -> RawSource:
    return RawSource(
        source.name, (uri,), source.format, source.autodetect, source.base_path, source.schema
    )


def _create(spark, source, uri, name, scan, partitions, definition) -> None:
    options = {"header": "true"} if source.format == "CSV" else {}
    # Partitions have places of their own; the table's is not looked into.
    place = {"path": uri if not partitions else (source.base_path or uri.split("*")[0])}
    listed = ", ".join(f"{_text(k)} {_text(v)}" for k, v in {**options, **place}.items())
    marks = {_DEFINITION: definition, GUARD: str(source.require_partition_filter).lower()}
    spark.sql(
        f"CREATE TABLE {name} ({scan.schema.toDDL()}) USING {FORMATS[source.format]}"
        f" OPTIONS ({listed})"
        + (f" PARTITIONED BY ({', '.join(map(quoted, partitions))})" if partitions else "")
        + f" TBLPROPERTIES ({', '.join(f'{_text(k)} = {_text(v)}' for k, v in marks.items())})"
    )


def _add_partitions(spark: SparkSession, name: str, scan: DataFrame, partitions: list[str]) -> None:
    """Make the folders that hold rows of the source the partitions of the table.

    They are found by the tasks, from the places of files alone: no column is read. One line
    per folder comes to the driver, as the catalog's statements need.
    """
    folder = F.regexp_replace("_metadata.file_path", "/[^/]*$", "")
    found = {}
    for row in scan.select(folder.alias("folder")).distinct().collect():
        place = unquote(row["folder"])
        steps = dict(step.split("=", 1) for step in place.split("/") if "=" in step)
        found[tuple((column, unquote(steps[column])) for column in partitions)] = place
    known = partition_locations(spark, name)
    for verb, specs in (
        ("DROP IF EXISTS", [(s, None) for s in known if s not in found]),
        ("ADD IF NOT EXISTS", [(s, at) for s, at in found.items() if s not in known]),
    ):
        for k in range(0, len(specs), _AT_ONCE):
            some = specs[k : k + _AT_ONCE]
            if verb.startswith("DROP"):
                listed = ", ".join(f"PARTITION ({_values(spec)})" for spec, _ in some)
            else:
                listed = " ".join(f"PARTITION ({_values(s)}) LOCATION {_text(at)}" for s, at in some)
            spark.sql(f"ALTER TABLE {name} {verb} {listed}")


def _values(spec) -> str:
    null = "__HIVE_DEFAULT_PARTITION__"
    return ", ".join(
        f"{quoted(column)} = {'NULL' if value == null else _text(value)}" for column, value in spec
    )


def _text(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"
