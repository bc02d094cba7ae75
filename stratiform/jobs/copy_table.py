"""Copy a table into a catalog table.

    spark-submit --py-files stratiform.zip stratiform/jobs/copy_table.py \\
        --source raw_ext_dev.sample_ext --catalog warehouse --namespace curated_iceberg_dev --table sample_ext

Exit codes: 0 done, 1 failed, 2 the target catalog is not configured.
"""

from __future__ import annotations

import argparse
import logging
import sys

from pyspark.sql import DataFrame, SparkSession

from stratiform.session import PROFILES, build_session, diagnostics, session_conf
from stratiform.sinks import ensure_namespace, verify_readable, write_table
from stratiform.sources import preview, read_query

log = logging.getLogger(__name__)

OK, FAILED, MISCONFIGURED = 0, 1, 2


class CatalogNotConfigured(RuntimeError):
    """The target names a catalog the session knows nothing about."""


def require_catalog(spark: SparkSession, catalog: str) -> None:
    if catalog == "spark_catalog":
        return
    base = f"spark.sql.catalog.{catalog}"
    if not spark.conf.get(base, None) or not spark.conf.get(f"{base}.warehouse", None):
        raise CatalogNotConfigured(f"set {base} and {base}.warehouse when submitting")


def copy_table(
    spark: SparkSession,
    source: str | DataFrame,
    target: str,
    mode: str = "overwrite",
    *,
    jdbc: dict | None = None,
) -> DataFrame:
    """Read, check access with one row, make the namespace, write, read one row back.

    ``source`` is a table name, or a frame already read. Nothing counts the rows:
    that would scan the source a second time.
    """
    parts = target.split(".")
    if len(parts) > 2:
        require_catalog(spark, parts[0])
    df = source
    if not isinstance(df, DataFrame):
        df = read_query(spark, f"SELECT * FROM {source}", jdbc=jdbc)
    log.info("source schema: %s", df.schema.simpleString())
    preview(df, 1).collect()
    if len(parts) > 1:
        ensure_namespace(spark, ".".join(parts[:-1]))
    write_table(df, target, mode)
    verify_readable(spark, target)
    return spark.table(target)


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    p.add_argument("--source", required=True, help="table to read, namespace.table")
    p.add_argument("--catalog", required=True, help="target catalog")
    p.add_argument("--namespace", required=True)
    p.add_argument("--table", required=True)
    p.add_argument("--mode", default="overwrite", choices=["overwrite", "append"])
    p.add_argument("--jdbc-url", help="run the read as a query on this database")
    p.add_argument("--profile", choices=sorted(PROFILES), help="sizes of driver and executors")
    p.add_argument("--checkpoint-dir", help="folder that all executors share")
    p.add_argument("--debug", action="store_true")
    return p.parse_args(argv)


def main(argv: list[str] | None = None) -> int:
    args = parse_args(argv)
    logging.basicConfig(level=logging.DEBUG if args.debug else logging.INFO)
    conf = session_conf(args.profile, checkpoint_dir=args.checkpoint_dir)
    spark = build_session("copy-table", conf)
    for key, value in diagnostics(spark, args.catalog).items():
        log.info("%s = %s", key, value)
    target = f"{args.catalog}.{args.namespace}.{args.table}"
    jdbc = {"url": args.jdbc_url} if args.jdbc_url else None
    try:
        copy_table(spark, args.source, target, args.mode, jdbc=jdbc)
    except CatalogNotConfigured as err:
        log.error("%s", err)
        return MISCONFIGURED
    except Exception:
        log.exception("copy failed")
        return FAILED
    return OK


if __name__ == "__main__":
    sys.exit(main())
