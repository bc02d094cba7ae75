"""Questions Spark's public API does not answer about paths and catalogs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _hadoop(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _hadoop(spark, path)
    return fs.exists(jpath)


def matches(spark: SparkSession, glob: str) -> bool:
    """Whether a path, possibly with wildcards, names anything."""
    fs, jpath = _hadoop(spark, glob)
    found = fs.globStatus(jpath)
    return found is not None and len(found) > 0


def size_in_bytes(spark: SparkSession, path: str) -> int:
    fs, jpath = _hadoop(spark, path)
    return fs.getContentSummary(jpath).getLength()


def delete_path(spark: SparkSession, path: str) -> None:
    fs, jpath = _hadoop(spark, path)
    fs.delete(jpath, True)


def write_note(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there as a whole or not at all."""
    fs, jpath = _hadoop(spark, path)
    _, draft = _hadoop(spark, f"{path}.draft")
    out = fs.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not fs.rename(draft, jpath):
        raise OSError(f"cannot write {path}")


def read_note(spark: SparkSession, path: str) -> str | None:
    fs, jpath = _hadoop(spark, path)
    if not fs.exists(jpath):
        return None
    stream = fs.open(jpath)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def is_v2(spark: SparkSession, table: str) -> bool:
    """Whether the table's catalog is a DataSource V2 catalog set on the session.

    The writers choose their statements by this, never by trying one and
    catching whatever comes back.
    """
    parts = table.split(".")
    catalog = parts[0] if len(parts) > 2 else spark.catalog.currentCatalog()
    return bool(spark.conf.get(f"spark.sql.catalog.{catalog}", None))


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if there is no folder."""
    fs, jpath = _hadoop(spark, path)
    if not fs.exists(jpath):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(jpath))


def estimated_bytes(df: DataFrame) -> int:
    """What the optimizer takes the frame for, from its sources; joins count as products."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def partition_locations(spark: SparkSession, table: str) -> dict[tuple[tuple[str, str], ...], str]:
    """Where each partition of a catalog table lies, by its columns and values.

    SQL tells names of partitions, and the place of one at a time only.
    """
    state, jvm = spark._jsparkSession.sessionState(), spark._jvm
    name = state.sqlParser().parseTableIdentifier(table)
    found = state.catalog().listPartitions(name, jvm.scala.Option.empty())
    result = {}
    for k in range(found.size()):
        partition = found.apply(k)
        pairs = partition.spec().toSeq()
        spec = tuple((pairs.apply(j)._1(), pairs.apply(j)._2()) for j in range(pairs.size()))
        result[spec] = partition.location().toString()
    return result


def table_properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def table_property(spark: SparkSession, table: str, key: str) -> str | None:
    return table_properties(spark, table).get(key)


def partition_schema(df: DataFrame) -> list[str]:
    """Columns of a plain file scan that come from the names of its folders."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    return list(leaves.apply(0).relation().partitionSchema().fieldNames())
