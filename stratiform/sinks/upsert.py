"""Keyed upsert into a partitioned table.

Rows whose key is in the new data are replaced, new keys are added, everything else
stays: nothing is ever deleted. Keys compare null-safe, so a NULL customer is updated
rather than added again on each run. One writer at a time.

V2 catalogs do this with MERGE. Without one, only the partitions the new data touches
are rewritten, and each row of them once:

1. the new rows are written to the shared folder, so they are computed once;
2. the touched partitions are read, without the keys that are replaced, and written together
   with the new rows as the partitions of a new version;
3. the new version takes the other partitions from the one before, where they lie, and the
   name is pointed at it.

For a table the last step is one statement (see ``versions``), for a path one small file
(see ``manifests``). Up to it readers find all partitions as they were, after it all as they
are; a job that dies before it has changed nothing.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.sinks import manifests, versions
from stratiform.sinks.tables import arrange, publish_table, staged
from stratiform.storage import children, is_v2, table_properties


class DuplicateKeys(ValueError):
    """The new data has several rows for one key, so no single one can win."""


def upsert_partitions(
    new: DataFrame,
    target: str,
    *,
    keys: Sequence[str],
    partition_col: str,
    check_unique: bool = True,
    properties: Mapping[str, str] | None = None,
    require_partition_filter: bool | None = None,
) -> DataFrame:
    """Upsert ``new`` into a table name or a path and return the target.

    A missing target is created from ``new``, a table with ``properties`` and the guard. Pass
    ``check_unique=False`` when the keys are unique by construction, as after grouping by them.
    """
    spark = new.sparkSession
    keys = list(keys)
    is_path = "/" in target
    layout = {"properties": properties, "require_partition_filter": require_partition_filter}
    exists = manifests.exists(spark, target) if is_path else spark.catalog.tableExists(target)
    if not exists and not check_unique:
        return _build(new, target, partition_col, layout)
    with staged(new, "upsert-new") as (rows, _):
        if check_unique:
            _refuse_duplicates(rows, keys)
        if not exists:
            return _build(rows, target, partition_col, layout)
        if is_path:
            return _upsert_path(rows, target, keys, partition_col)
        if is_v2(spark, target):
            return _merge(rows, target, keys, partition_col)
        return _upsert_table(rows, target, keys, partition_col)


def _build(new: DataFrame, target: str, partition_col: str, layout: Mapping) -> DataFrame:
    if "/" not in target:
        return publish_table(new, target, partition_by=[partition_col], **layout)
    folder = manifests.new_folder(target)
    _write(new, f"{target.rstrip('/')}/{folder}", partition_col)
    parts = children(new.sparkSession, f"{target.rstrip('/')}/{folder}")
    manifests.publish(new.sparkSession, target, [f"{folder}/{p}" for p in _partitions(parts)])
    return manifests.read(new.sparkSession, target, new.schema)


def _write(rows: DataFrame, path: str, partition_col: str) -> None:
    arrange(rows, [partition_col]).write.partitionBy(partition_col).parquet(path)


def _partitions(names: Sequence[str]) -> list[str]:
    return [name for name in names if "=" in name]


def _merged(
    current: DataFrame, rows: DataFrame, keys: Sequence[str], partition_col: str
) -> DataFrame:
    """All rows of the touched partitions as they will be."""
    replaced = rows.select(*[F.col(k).alias(f"_new_{k}") for k in keys])
    kept = _touched(current, rows, partition_col).join(replaced, _same_keys(keys), "left_anti")
    return kept.unionByName(rows).select(*current.columns)


def _upsert_table(
    rows: DataFrame, target: str, keys: Sequence[str], partition_col: str
) -> DataFrame:
    spark = rows.sparkSession
    before = versions.adopt(spark, target)
    shown, kept = spark.table(target), table_properties(spark, before)
    version, location = versions.new_version(spark, target)
    _write(_merged(shown, rows, keys, partition_col), location, partition_col)
    if _partitions(children(spark, location)):
        own = {k: v for k, v in kept.items() if not k.startswith("transient")}
        ddl = spark.table(before).schema.toDDL()
        versions.declare(spark, version, location, ddl, [partition_col], own)
        versions.borrow(spark, version, before)
        comment = spark.catalog.getTable(target).description
        described = table_properties(spark, target)
        versions.point(spark, target, version, shown.columns, comment, described)
    return spark.table(target)


def _upsert_path(
    rows: DataFrame, target: str, keys: Sequence[str], partition_col: str
) -> DataFrame:
    spark = rows.sparkSession
    root = target.rstrip("/")
    before = manifests.folders(spark, target)
    current = manifests.read(spark, target, rows.schema)
    folder = manifests.new_folder(target)
    _write(_merged(current, rows, keys, partition_col), f"{root}/{folder}", partition_col)
    written = _partitions(children(spark, f"{root}/{folder}"))
    if written:
        others = [f for f in before if f.rsplit("/", 1)[-1] not in written]
        manifests.publish(spark, target, [*others, *(f"{folder}/{p}" for p in written)])
    return manifests.read(spark, target, rows.schema)


def _same_keys(keys: Sequence[str]) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(key).eqNullSafe(F.col(f"_new_{key}"))
    return condition


def _touched(current: DataFrame, new: DataFrame, partition_col: str) -> DataFrame:
    """Rows of the partitions that occur in the new data.

    One row comes to the driver: the range of values prunes partitions as literals do, and
    a semi-join leaves out what lies between.
    """
    column = F.col(partition_col)
    values = new.select(column.alias("_touched")).distinct()
    return current.where(_range(new, partition_col, column)).join(
        values, column.eqNullSafe(F.col("_touched")), "left_semi"
    )


def _range(new: DataFrame, partition_col: str, column: Column) -> Column:
    """That ``column`` lies within the partition values of the new rows, as literals."""
    value = F.col(partition_col)
    least, most, nulls = new.agg(F.min(value), F.max(value), F.count_if(value.isNull())).first()
    condition = column.between(least, most) if least is not None else F.lit(False)
    return condition | column.isNull() if nulls else condition


def _refuse_duplicates(new: DataFrame, keys: Sequence[str]) -> None:
    repeated = new.groupBy(*keys).count().where(F.col("count") > 1)
    if not repeated.isEmpty():
        raise DuplicateKeys(f"several new rows share one key {tuple(keys)}")


def _merge(
    new: DataFrame, target: str, keys: Sequence[str], partition_col: str | None = None
) -> DataFrame:
    """MERGE by key. A partition column among the keys also gets the range of its new values,
    which changes no match and lets the catalog skip the other partitions."""
    table = target.split(".")[-1]
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(f"_new.{key}").eqNullSafe(F.col(f"{table}.{key}"))
    if partition_col in keys:
        condition = condition & _range(new, partition_col, F.col(f"{table}.{partition_col}"))
    new.alias("_new").mergeInto(
        target, condition
    ).whenMatched().updateAll().whenNotMatched().insertAll().merge()
    return new.sparkSession.table(target)
