"""Writing raw datasets where the sources expect to find them."""

from __future__ import annotations

import logging
from collections.abc import Iterable

from pyspark.sql import DataFrame

from stratiform.storage import path_exists, size_in_bytes

log = logging.getLogger(__name__)

_WRITERS = ("parquet", "csv", "json")

# The default of the text formats stops at milliseconds.
_TEXT_TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def landing_path(root: str, domain: str, dataset: str) -> str:
    return f"{root.rstrip('/')}/domain={domain}/dataset={dataset}"


def land_raw(
    df: DataFrame,
    root: str,
    domain: str,
    dataset: str,
    *,
    file_format: str = "parquet",
    partition_by: Iterable[str] = (),
    mode: str = "append",
) -> str:
    """Write a dataset under ``domain=/dataset=`` and check that bytes arrived.

    Raw data is immutable, hence append by default. Each task writes its own
    files; nothing is gathered into one.
    """
    if file_format not in _WRITERS:
        raise ValueError(f"cannot land {file_format!r}, expected one of {_WRITERS}")
    path = landing_path(root, domain, dataset)
    appended = mode == "append" and path_exists(df.sparkSession, path)
    before = size_in_bytes(df.sparkSession, path) if appended else 0
    writer = df.write.mode(mode).format(file_format)
    if file_format != "parquet":
        writer = writer.option("timestampFormat", _TEXT_TIMESTAMP)
    if file_format == "csv":
        writer = writer.option("header", True)
    keys = list(partition_by)
    if keys:
        writer = writer.partitionBy(*keys)
    writer.save(path)
    size = size_in_bytes(df.sparkSession, path) - before
    if size <= 0:
        raise OSError(f"nothing was written to {path}")
    log.info("landed %s (%d bytes)", path, size)
    return path


def seed_raw(df: DataFrame, root: str, domain: str, datasets: Iterable[str]) -> list[str]:
    """Land the same frame as several datasets."""
    return [land_raw(df, root, domain, name) for name in datasets]
