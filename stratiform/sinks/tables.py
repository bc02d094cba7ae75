"""Views, full-refresh tables and appends."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.operators.checks import Check, QualityError, enforce, failed, observed
from stratiform.operators.checks import run_checks
from stratiform.session import fresh_path
from stratiform.sinks import versions
from stratiform.sources.readers import GUARD
from stratiform.storage import delete_path, estimated_bytes, is_v2, table_properties

# Up to this many bytes for each core, by the optimizer's estimate, a partitioned write is
# spread over the cores by partition value instead of being packed into few tasks.
_SMALL_BYTES = 128 * 1024**2


def publish_view(df: DataFrame, name: str) -> DataFrame:
    """A view is evaluated anew on each read."""
    df.createOrReplaceTempView(name)
    return df


def ensure_namespace(spark: SparkSession, namespace: str, location: str | None = None) -> None:
    """Create a namespace unless it exists; ``location`` is where its tables go."""
    where = f" LOCATION {versions.text(location)}" if location else ""
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {namespace}{where}")


def arrange(
    df: DataFrame, partition_by: Sequence[str] = (), cluster_by: Sequence[str] = ()
) -> DataFrame:
    """Bring rows that share files together before a write.

    Partitioned tables are rebalanced by partition value: each value goes to few
    files, and adaptive execution cuts a value with too many rows into several tasks.
    It also merges small tasks, which leaves a small frame with thousands of values to one
    task that makes all the files; such a frame is dealt to the cores by value instead.
    Clustered tables are cut into ranges of the cluster columns; a hash of the whole
    row as last range column lets a range end within a frequent value. Sorting lets
    Parquet statistics skip what a filter on those columns does not need.
    """
    partition_by, cluster_by = list(partition_by), list(cluster_by)
    if partition_by:
        keys = [F.col(c) for c in partition_by]
        width = _width_if_small(df)
        df = df.repartition(width, *keys) if width else df.hint("rebalance", *keys)
        return df.sortWithinPartitions(*partition_by, *cluster_by) if cluster_by else df
    if cluster_by:
        spread = F.xxhash64(*df.columns)
        return df.repartitionByRange(*cluster_by, spread).sortWithinPartitions(*cluster_by)
    return df


def _width_if_small(df: DataFrame) -> int | None:
    """How many tasks write a frame that is surely small.

    The optimizer takes an aggregate for as large as its input, so a frame that counts as
    small is. Rebalancing, which can cut a frequent value, is for the others.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    advised = df.sparkSession.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    limit = min(_SMALL_BYTES, _bytes(df.sparkSession, advised)) * cores
    return 2 * cores if estimated_bytes(df) <= limit else None


def _bytes(spark: SparkSession, size: str) -> int:
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(size)


def write_partitioned(
    df: DataFrame,
    path: str,
    *,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    mode: str = "errorifexists",
) -> DataFrame:
    """Write Parquet files arranged for reading and return the scan of them."""
    writer = arrange(df, partition_by, cluster_by).write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def staged(df: DataFrame, label: str) -> Iterator[tuple[DataFrame, str]]:
    """The frame as written to the shared folder, without its lineage, and the path.

    The copy goes once the block is done; after an error it stays, for repair.
    """
    path = fresh_path(df.sparkSession, label)
    yield write_partitioned(df, path), path
    delete_path(df.sparkSession, path)


def publish_table(
    df: DataFrame,
    table: str,
    *,
    checks: Sequence[Check] = (),
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    bucket_by: Sequence[str] = (),
    buckets: int | None = None,
    comment: str | None = None,
    properties: Mapping[str, str] | None = None,
    require_partition_filter: bool | None = None,
) -> DataFrame:
    """Full refresh of a table: write and check, then publish by one statement.

    The checks are counted while the rows are written, so nothing reads them twice. Only if
    they hold does the name point at the new files (see ``versions``); a run that fails
    leaves the published table alone, its rows stay where the error says. Readers find the
    rows before or the new ones, at any moment. The version before stays until the next
    publication.

    ``require_partition_filter`` says whether guarded reads have to name partitions; unless
    given, that stays as it is. With ``bucket_by`` rows of one key share a file, sorted:
    groupings and joins on the key need no exchange. The number of ``buckets`` is that of the
    version before unless given, and follows from the size at first.
    """
    spark = df.sparkSession
    if is_v2(spark, table):
        return _publish_v2(df, table, checks, partition_by, cluster_by, comment, properties)
    table = table.removeprefix("spark_catalog.")
    version, location = versions.new_version(spark, table)
    described = {**(properties or {}), **_guard(spark, table, require_partition_filter)}
    if bucket_by:
        if partition_by or cluster_by:
            raise ValueError("a bucketed table is neither partitioned nor clustered")
        number = buckets or versions.bucket_number(spark, table) or _buckets_for(df)
        # The writer's buckets are the partitions of this shuffle, so each is one file.
        sorted_ = df.repartition(number, *bucket_by).sortWithinPartitions(*bucket_by)
        watched, counted = observed(sorted_, checks)
        writer = watched.write.bucketBy(number, *bucket_by).sortBy(*bucket_by)
        writer.option("path", location).saveAsTable(version)
        problems = failed(counted, checks)
        if problems:
            spark.sql(f"DROP TABLE {version}")  # the files stay
        _refuse(problems, table, location)
        marks = versions.pairs({**described, versions.LOCATION: location})
        spark.sql(f"ALTER TABLE {version} SET TBLPROPERTIES ({marks})")
    else:
        watched, counted = observed(arrange(df, partition_by, cluster_by), checks)
        writer = watched.write
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(location)
        _refuse(failed(counted, checks), table, location)
        versions.declare(spark, version, location, df.schema.toDDL(), partition_by, described)
    versions.point(spark, table, version, df.columns, comment, described)
    return spark.table(table)


def _buckets_for(df: DataFrame) -> int:
    """A bucket for each 128 MiB by the optimizer's estimate, 8 at least."""
    return max(8, -(-estimated_bytes(df) // _SMALL_BYTES))


def _guard(spark: SparkSession, table: str, required: bool | None) -> dict[str, str]:
    if required is None:
        found = table_properties(spark, table) if spark.catalog.tableExists(table) else {}
        return {GUARD: found[GUARD]} if GUARD in found else {}
    return {GUARD: str(required).lower()}


def _refuse(problems: Sequence[str], table: str, where: str) -> None:
    if problems:
        raise QualityError(f"{table} not published, rows kept in {where}: {'; '.join(problems)}")


def write_v2(
    df: DataFrame,
    table: str,
    mode: str = "overwrite",
    *,
    partition_by: Sequence[str] = (),
    properties: Mapping[str, str] | None = None,
) -> None:
    """Create-or-replace or append on a V2 catalog; both are atomic there."""
    writer = df.writeTo(table)
    if mode == "append":
        writer.append()
        return
    if mode != "overwrite":
        raise ValueError(f"unknown mode {mode!r}, expected overwrite or append")
    if partition_by:
        writer = writer.partitionedBy(*[F.col(c) for c in partition_by])
    for key, value in (properties or {}).items():
        writer = writer.tableProperty(key, value)
    writer.createOrReplace()


def append_table(df: DataFrame, table: str) -> None:
    """Add rows to an existing table, matching columns by name.

    Rows of a partitioned table are arranged first: few files per partition, not one
    per partition and task. The rows go into the current version.
    """
    spark = df.sparkSession
    if is_v2(spark, table):
        write_v2(df, table, "append")
        return
    version = versions.current(spark, table) or table
    target = spark.table(version).columns
    if set(df.columns) != set(target):
        raise ValueError(f"columns {df.columns} do not match those of {table}: {target}")
    parts = [c.name for c in spark.catalog.listColumns(version) if c.isPartition]
    arrange(df.select(*target), parts).write.insertInto(version)


def write_table(df: DataFrame, table: str, mode: str = "overwrite", **layout) -> None:
    """Overwrite or append with the statements the table's catalog supports."""
    spark = df.sparkSession
    if mode not in ("overwrite", "append"):
        raise ValueError(f"unknown mode {mode!r}, expected overwrite or append")
    if mode == "append" and spark.catalog.tableExists(table):
        append_table(df, table)
    else:
        publish_table(df, table, **layout)


def verify_readable(spark: SparkSession, table: str) -> None:
    """Read one row back."""
    spark.read.table(table).limit(1).collect()


def _publish_v2(df, table, checks, partition_by, cluster_by, comment, properties) -> DataFrame:
    described = {**(properties or {}), **({"comment": comment} if comment else {})}
    layout = {"partition_by": partition_by, "properties": described}
    if checks:
        with staged(df, "publish") as (copy, path):
            _audit(copy, checks, table, path)
            write_v2(arrange(copy, partition_by, cluster_by), table, **layout)
    else:
        write_v2(arrange(df, partition_by, cluster_by), table, **layout)
    return df.sparkSession.table(table)


def _audit(written: DataFrame, checks: Sequence[Check], table: str, where: str) -> None:
    if not checks:
        return
    try:
        enforce(run_checks(written, checks))
    except QualityError as err:
        raise QualityError(f"{table} not published, rows kept in {where}: {err}") from err
