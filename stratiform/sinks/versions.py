"""Published tables: a name that points at one version of its files.

The name is a view over a version, an ordinary table called ``<name>__<id>`` with partitions
of its own. ``CREATE OR REPLACE VIEW`` is one statement, so readers find the version before or
the new one and never neither, whatever changes with it: rows, columns, their order, layout.
The view says which version it shows (``VERSION``) and which came before (``PREVIOUS``).

A version may have partitions that lie in the folder of an earlier one. The one before
the current stays for readers that have begun; what neither needs is removed after the next
publication. What a dead writer left behind no name points at, so it goes then, too. One
writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import SparkSession

from stratiform.sources.readers import GUARD
from stratiform.storage import children, delete_path, partition_locations, table_properties

VERSION = "stratiform.version"
PREVIOUS = "stratiform.previous"
# Marks the tables made here, so that no other is ever deleted.
LOCATION = "stratiform.location"

# Partitions added by one statement.
_AT_ONCE = 500
_NULL = "__HIVE_DEFAULT_PARTITION__"


def current(spark: SparkSession, name: str) -> str | None:
    """The table that holds the rows of a published name; any other table is its own."""
    if not spark.catalog.tableExists(name):
        return None
    return table_properties(spark, name).get(VERSION, name)


def new_version(spark: SparkSession, name: str) -> tuple[str, str]:
    """Name and folder of a version that does not exist yet."""
    namespace, short = split(spark, name)
    root = spark.catalog.getDatabase(namespace).locationUri.rstrip("/")
    version = f"{short}__{uuid.uuid4().hex[:12]}"
    return f"{namespace}.{version}", f"{root}/{version}"


def declare(
    spark: SparkSession,
    version: str,
    location: str,
    ddl: str,
    partition_by: Sequence[str] = (),
    properties: Mapping[str, str] | None = None,
) -> None:
    """Make files that are written, arranged or not, a table."""
    spark.sql(
        f"CREATE TABLE {version} ({ddl}) USING parquet"
        + (f" PARTITIONED BY ({', '.join(map(quoted, partition_by))})" if partition_by else "")
        + f" LOCATION {text(location)}"
        + f" TBLPROPERTIES ({pairs({**(properties or {}), LOCATION: location})})"
    )
    if partition_by:
        spark.catalog.recoverPartitions(version)


def borrow(spark: SparkSession, version: str, lender: str) -> None:
    """Give a version those partitions of another that it has not, where they lie."""
    own = partition_locations(spark, version)
    lent = [(s, at) for s, at in partition_locations(spark, lender).items() if s not in own]

    for k in range(0, len(lent), _AT_ONCE):
        some = lent[k : k + _AT_ONCE]
        places = " ".join(f"PARTITION ({_values(s)}) LOCATION {text(at)}" for s, at in some)
        spark.sql(f"ALTER TABLE {version} ADD IF NOT EXISTS {places}")


def point(
    spark: SparkSession,
    name: str,
    version: str,
    columns: Sequence[str],
    comment: str | None = None,
    properties: Mapping[str, str] | None = None,
) -> None:
    """Let the name show a version, in one statement, and remove what nobody needs then."""
    before = adopt(spark, name)
    _show(spark, name, version, columns, comment, {**(properties or {}), **_shows(version, before)})
    sweep(spark, name)


def adopt(spark: SparkSession, name: str) -> str | None:
    """The current version; a table that was not published here becomes one first.

    Its name is free for a moment then, the only one in which readers can miss it.
    """
    version = current(spark, name)
    if version is None or version != name:
        return version
    columns, properties = spark.table(name).columns, table_properties(spark, name)
    version, _ = new_version(spark, name)
    before = _place(spark, name)
    spark.sql(f"ALTER TABLE {name} RENAME TO {version}")
    _move_partitions(spark, version, before, _place(spark, version))
    guard = {k: v for k, v in properties.items() if k == GUARD}
    _show(spark, name, version, columns, None, {**guard, **_shows(version, None)})
    return version


def _place(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"].rstrip("/") if rows else ""


def _move_partitions(spark: SparkSession, table: str, before: str, now: str) -> None:
    """A managed table takes its files along when its name changes; partitions follow here
    where the catalog leaves them behind."""
    if before == now or not any(c.isPartition for c in spark.catalog.listColumns(table)):
        return
    for spec, location in partition_locations(spark, table).items():
        path = location.replace("file:///", "file:/")
        if path.startswith(f"{before}/"):
            moved = text(now + path[len(before) :])
            spark.sql(f"ALTER TABLE {table} PARTITION ({_values(spec)}) SET LOCATION {moved}")


def _values(spec) -> str:
    return ", ".join(
        f"{quoted(column)} = {'NULL' if value == _NULL else text(value)}" for column, value in spec
    )


def _shows(version: str, before: str | None) -> dict[str, str]:
    return {VERSION: version, PREVIOUS: before} if before else {VERSION: version}


def _show(spark, name, version, columns, comment, properties) -> None:
    spark.sql(
        f"CREATE OR REPLACE VIEW {name}"
        + (f" COMMENT {text(comment)}" if comment else "")
        + f" TBLPROPERTIES ({pairs(properties)})"
        + f" AS SELECT {', '.join(map(quoted, columns))} FROM {version}"
    )


def sweep(spark: SparkSession, name: str) -> None:
    """Remove versions other than the current and the one before, and folders they do not need."""
    namespace, short = split(spark, name)
    shown = table_properties(spark, name)
    kept = {v.split(".")[-1] for v in (shown.get(VERSION), shown.get(PREVIOUS)) if v}
    needed = set()
    for version in _versions(spark, namespace, short):
        table = f"{namespace}.{version}"
        if version in kept:
            needed |= _folders(spark, table, short)
        elif LOCATION in table_properties(spark, table):
            spark.sql(f"DROP TABLE IF EXISTS {table}")
    root = spark.catalog.getDatabase(namespace).locationUri.rstrip("/")
    for folder in children(spark, root):
        if not _is_version(folder, short) or folder in kept:
            continue
        if folder not in {place[0] for place in needed}:
            delete_path(spark, f"{root}/{folder}")
            continue
        for part in children(spark, f"{root}/{folder}"):
            if (folder, part) not in needed:
                delete_path(spark, f"{root}/{folder}/{part}")


def _versions(spark: SparkSession, namespace: str, short: str) -> list[str]:
    rows = spark.sql(f"SHOW TABLES IN {namespace} LIKE '{short}__*'").collect()
    return [r["tableName"] for r in rows if _is_version(r["tableName"], short)]


def _folders(spark: SparkSession, version: str, short: str) -> set[tuple[str, str]]:
    """Version folders that hold partitions of a version, with the folder right below."""
    if not any(c.isPartition for c in spark.catalog.listColumns(version)):
        return set()
    found = set()
    for location in partition_locations(spark, version).values():
        steps = location.split("/")
        at = next((k for k, step in enumerate(steps) if _is_version(step, short)), None)
        if at is not None and at + 1 < len(steps):
            found.add((steps[at], steps[at + 1]))
    return found


def _is_version(name: str, short: str) -> bool:
    head, found, tail = name.rpartition("__")
    return bool(found) and head == short and len(tail) == 12 and set(tail) <= set("0123456789abcdef")


def bucket_number(spark: SparkSession, name: str) -> int | None:
    """How many buckets the current version has; None if it has none."""
    version = current(spark, name)
    if version is None:
        return None
    rows = spark.sql(f"DESCRIBE FORMATTED {version}").where("col_name = 'Num Buckets'").collect()
    return int(rows[0]["data_type"]) if rows else None


def set_guard(spark: SparkSession, name: str, required: bool) -> None:
    """Whether reads of a published table have to name partitions, from now on."""
    version = current(spark, name)
    value = f"({text(GUARD)} = {text(str(required).lower())})"
    spark.sql(f"ALTER TABLE {version} SET TBLPROPERTIES {value}")
    if version != name:
        spark.sql(f"ALTER VIEW {name} SET TBLPROPERTIES {value}")


def split(spark: SparkSession, table: str) -> tuple[str, str]:
    *namespace, name = table.split(".")
    return ".".join(namespace) or spark.catalog.currentDatabase(), name


def quoted(column: str) -> str:
    return f"`{column.replace('`', '``')}`"


def text(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def pairs(properties: Mapping[str, str]) -> str:
    return ", ".join(f"{text(k)} = {text(v)}" for k, v in properties.items())
