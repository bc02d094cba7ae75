from stratiform.sources.catalog import declare_raw, declare_sources, read_declared
from stratiform.sources.landing import land_raw, landing_path, seed_raw
from stratiform.sources.readers import (
    PartitionFilterRequired,
    SourceUnavailable,
    env_check,
    one_row,
    preview,
    read_curated,
    read_partitioned,
    read_query,
    read_table,
)
from stratiform.sources.registry import (
    RawSource,
    SourceFormatUnavailable,
    enabled_sources,
    read_raw,
)

__all__ = [
    "PartitionFilterRequired",
    "RawSource",
    "SourceFormatUnavailable",
    "SourceUnavailable",
    "declare_raw",
    "declare_sources",
    "enabled_sources",
    "env_check",
    "land_raw",
    "landing_path",
    "one_row",
    "preview",
    "read_curated",
    "read_declared",
    "read_partitioned",
    "read_query",
    "read_raw",
    "read_table",
    "seed_raw",
]
