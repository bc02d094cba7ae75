from stratiform.sinks.tables import (
    append_table,
    arrange,
    ensure_namespace,
    publish_table,
    publish_view,
    staged,
    verify_readable,
    write_partitioned,
    write_table,
    write_v2,
)
from stratiform.sinks.upsert import DuplicateKeys, upsert_partitions
from stratiform.sinks.versions import set_guard

__all__ = [
    "DuplicateKeys",
    "append_table",
    "arrange",
    "ensure_namespace",
    "publish_table",
    "publish_view",
    "set_guard",
    "staged",
    "upsert_partitions",
    "verify_readable",
    "write_partitioned",
    "write_table",
    "write_v2",
]
