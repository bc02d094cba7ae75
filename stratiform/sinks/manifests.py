"""Partitioned Parquet at a path, published by one small file.

Below the path, every write has a folder of its own, ``_version=<id>``, with folders of
partitions. A manifest, ``_manifests/<number>``, lists the partition folders that count, and
the highest number is the current one. Written under another name and renamed, a manifest is
there as a whole or not at all, so several partitions change at once. Folders that neither
the current nor the manifest before lists are removed after each publication.

A catalog table is the better target: Spark looks up the partitions of a query there, while
here the list is read on the driver. Reading the path without the manifest would find
replaced rows, too, so read it with :func:`read`.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from stratiform.storage import children, delete_path, read_note, write_note

_FOLDER = "_version"
_MANIFESTS = "_manifests"


def _numbers(spark: SparkSession, path: str) -> list[int]:
    names = children(spark, f"{path.rstrip('/')}/{_MANIFESTS}")
    return sorted(int(name) for name in names if name.isdigit())


def exists(spark: SparkSession, path: str) -> bool:
    """Whether something was published there; files without a manifest are an error."""
    if _numbers(spark, path):
        return True
    if any("=" in name and not name.startswith(_FOLDER) for name in children(spark, path)):
        raise ValueError(f"{path} holds partitions that no manifest lists")
    return False


def new_folder(path: str) -> str:
    return f"{_FOLDER}={uuid.uuid4().hex[:12]}"


def folders(spark: SparkSession, path: str, back: int = 0) -> list[str]:
    """Partition folders of the current manifest, or of one some publications back."""
    numbers = _numbers(spark, path)
    if len(numbers) <= back:
        return []
    lines = read_note(spark, f"{path.rstrip('/')}/{_MANIFESTS}/{numbers[-1 - back]:012d}")
    return [line for line in (lines or "").split("\n") if line]


def publish(spark: SparkSession, path: str, listed: Sequence[str]) -> None:
    """Make these folders the current ones, then remove what the last two do not list."""
    root = path.rstrip("/")
    number = max(_numbers(spark, path), default=0) + 1
    write_note(spark, f"{root}/{_MANIFESTS}/{number:012d}", "\n".join(sorted(listed)))
    needed = {*listed, *folders(spark, path, back=1)}
    versions = {folder.split("/")[0] for folder in needed}
    for version in children(spark, root):
        if not version.startswith(f"{_FOLDER}="):
            continue
        if version not in versions:
            delete_path(spark, f"{root}/{version}")
            continue
        for part in children(spark, f"{root}/{version}"):
            if "=" in part and f"{version}/{part}" not in needed:
                delete_path(spark, f"{root}/{version}/{part}")
    for old in _numbers(spark, path)[:-2]:
        delete_path(spark, f"{root}/{_MANIFESTS}/{old:012d}")


def read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of the folders that count."""
    root = path.rstrip("/")
    listed = [f"{root}/{folder}" for folder in folders(spark, path)]
    if not listed:
        return spark.createDataFrame([], schema)
    stored = T.StructType([*schema.fields, T.StructField(_FOLDER, T.StringType())])
    rows = spark.read.schema(stored).option("basePath", root).parquet(*listed)
    return rows.select(*[rows[f"`{name}`"] for name in schema.names])
