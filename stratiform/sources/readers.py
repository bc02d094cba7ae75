"""Reads of tables, partitions, queries and constants."""

from __future__ import annotations

import contextlib
import io
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.config import EnvConfig
from stratiform.storage import is_v2, path_exists, table_property

# The property of a table whose reads have to name partitions.
GUARD = "stratiform.require_partition_filter"


class PartitionFilterRequired(ValueError):
    """A guarded table was read without a predicate on its partitions."""


class SourceUnavailable(RuntimeError):
    """A read needs a catalog or connector the session does not have."""


@dataclass(frozen=True)
class TableRead:
    """A table as read: the lazy frame, its columns with their types, and some of its rows."""

    frame: DataFrame
    schema: dict[str, str]
    sample: list[dict]


def read_table(
    spark: SparkSession, table: str, where: Column | None = None, *, rows: int = 5
) -> TableRead:
    """Read a table by name, with its schema and any ``rows`` rows of it.

    Where the table wants a filter on its partitions, ``where`` has to be one. The sample takes
    only as many partitions as it needs.
    """
    df = read_partitioned(spark, table, where, require_filter=None)
    sample = [r.asDict() for r in preview(df, rows).collect()]
    return TableRead(df, dict(df.dtypes), sample)


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """Any ``n`` rows. Spark reads only as many partitions as it needs for them."""
    return df.limit(n)


def read_query(
    spark: SparkSession, sql: str, *, args: dict | None = None, jdbc: dict | None = None
) -> DataFrame:
    """Rows of a query text, run by Spark or, with ``jdbc`` options, by that database.

    Values go in as ``args``, never by pasting them into the text.
    """
    if jdbc is None:
        return spark.sql(sql, args=args) if args else spark.sql(sql)
    if args:
        raise ValueError("args are bound by Spark; a jdbc query takes none")
    return spark.read.format("jdbc").options(**jdbc).option("query", sql).load()


def read_partitioned(
    spark: SparkSession,
    source: str | DataFrame,
    where: Column | None = None,
    *,
    require_filter: bool | None = True,
) -> DataFrame:
    """Rows of a partitioned table or path that satisfy ``where``.

    With ``require_filter`` the read is refused unless Spark can use the predicate
    to skip partitions, so nobody scans the whole history by accident. With None the tables
    decide: each one below the source, by whatever name or view it comes, that carries the
    property ``GUARD`` needs such a predicate.
    """
    v2_table = False
    if isinstance(source, DataFrame):
        df = source
    elif "/" in source:
        df = spark.read.parquet(source)
    else:
        df = spark.read.table(source)
        v2_table = is_v2(spark, source)
    if where is not None:
        df = df.where(where)
    if require_filter is None:
        return guarded(df)
    if require_filter:
        named = v2_table and restricts(df, partition_columns(spark, source))
        if not (named or prunes_partitions(df)):
            raise PartitionFilterRequired("filter on a partition column, or lift the guard")
    return df


def guarded(df: DataFrame) -> DataFrame:
    """The frame, unless it scans a table that wants a partition filter without one.

    The catalog is asked for the property of each table each time, so a switch counts at
    once in every session.
    """
    open_scans = [t for t, pruned in scans(df) if t is not None and not pruned]
    for table in dict.fromkeys(open_scans):
        if table_property(df.sparkSession, table, GUARD) == "true":
            raise PartitionFilterRequired(f"{table} is read only with a filter on its partitions")
    return df


def scans(df: DataFrame) -> list[tuple[str | None, bool]]:
    """The file scans of the physical plan: the table, if it is one, and whether the scan
    skips partitions. That a partition has a value at all does not count: it skips next to nothing.
    """
    leaves = df._jdf.queryExecution().sparkPlan().collectLeaves()
    found = []
    for leaf in (leaves.apply(k) for k in range(leaves.size())):
        if leaf.getClass().getSimpleName() != "FileSourceScanExec":
            continue
        name, filters = leaf.tableIdentifier(), leaf.partitionFilters()
        terms = [filters.apply(k).nodeName() for k in range(filters.size())]
        table = name.get().unquotedString() if name.isDefined() else None
        found.append((table, any(term != "IsNotNull" for term in terms)))
    return found


def prunes_partitions(df: DataFrame) -> bool:
    """Whether a file scan of the plan skips partitions."""
    return any(pruned for _, pruned in scans(df))


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def restricts(df: DataFrame, columns: list[str]) -> bool:
    """Whether a filter of the frame has a term on nothing but these columns.

    V2 tables plan their pruning out of sight of the scan's description, so for them
    the predicate itself is looked at. ``IS NOT NULL`` does not count.
    """

    def terms(condition):
        if condition.nodeName() == "And":
            return terms(condition.left()) + terms(condition.right())
        return [condition]

    node, wanted = df._jdf.queryExecution().analyzed(), {c.lower() for c in columns}
    while node.nodeName() == "Filter":
        for term in terms(node.condition()):
            used = term.references().toSeq()
            names = {used.apply(k).name().lower() for k in range(used.size())}
            if names and names <= wanted and term.nodeName() != "IsNotNull":
                return True
        node = node.child()
    return False


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def read_curated(spark: SparkSession, cfg: EnvConfig, name: str) -> DataFrame:
    """All columns of a curated table: from the V2 catalog, else from its Parquet folder."""
    if cfg.catalog:
        return spark.table(cfg.table("curated_iceberg", name))
    if not cfg.curated_root:
        raise SourceUnavailable("curated tables need a catalog or a curated_root")
    path = f"{cfg.curated_root.rstrip('/')}/{name}"
    if not path_exists(spark, path):
        raise SourceUnavailable(f"no curated table at {path}")
    return spark.read.parquet(path)


def one_row(spark: SparkSession) -> DataFrame:
    return spark.range(1).select(F.lit(1).alias("one"))


def env_check(spark: SparkSession, cfg: EnvConfig) -> DataFrame:
    """One row telling which environment and namespaces a run resolved to."""
    return spark.range(1).select(
        F.lit(cfg.env).alias("env"),
        F.lit(cfg.namespace("raw_ext")).alias("raw_ext_dataset"),
        F.lit(cfg.namespace("analytics")).alias("analytics_dataset"),
    )
