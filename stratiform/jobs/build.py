"""Run the layers or the tagged models of an environment.

    spark-submit --py-files stratiform.zip stratiform/jobs/build.py \\
        --env dev --raw-root s3a://raw layers --to 03_gold
    spark-submit --py-files stratiform.zip stratiform/jobs/build.py \\
        --env prod --raw-root s3a://raw models --tags prod
    spark-submit --py-files stratiform.zip stratiform/jobs/build.py \\
        --env prod smoke --table curated_prod.sample_curated

Exit codes: 0 done, 1 failed; ``smoke`` gives the code of the check.
"""

from __future__ import annotations

import argparse
import datetime as dt
import logging
import sys

from stratiform.config import ENVIRONMENTS, EnvConfig
from stratiform.operators.smoke import smoke_check, smoke_check_source
from stratiform.plans import run_layers, run_models
from stratiform.plans.layers import LAYERS
from stratiform.session import PROFILES, build_session, session_conf
from stratiform.sources import RawSource, landing_path
from stratiform.sources.registry import enabled_sources, source_named

log = logging.getLogger(__name__)


def default_sources(raw_root: str, domain: str = "sales") -> tuple[RawSource, ...]:
    """The raw sources in the landing layout, by source name and dataset folder."""
    datasets = {
        "sample_ext": "sample",
        "orders": "orders",
        "sales_transactions": "sales_transactions",
    }
    return tuple(
        RawSource(name, (landing_path(raw_root, domain, dataset),))
        for name, dataset in datasets.items()
    )


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    p.add_argument("--env", default=ENVIRONMENTS[0], choices=ENVIRONMENTS)
    p.add_argument("--raw-root", default="", help="folder with domain=/dataset= below it")
    p.add_argument("--curated-root")
    p.add_argument("--catalog")
    p.add_argument("--no-sales-orders", action="store_true", help="their files have not landed")
    p.add_argument("--profile", choices=sorted(PROFILES), help="sizes of driver and executors")
    p.add_argument("--checkpoint-dir", help="folder that all executors share")
    sub = p.add_subparsers(dest="what", required=True)
    layers = sub.add_parser("layers")
    layers.add_argument("--from", dest="from_layer", default=LAYERS[0], choices=LAYERS)
    layers.add_argument("--to", dest="to_layer", default=LAYERS[-1], choices=LAYERS)
    layers.add_argument("--dry-run", action="store_true")
    models = sub.add_parser("models")
    models.add_argument("--tags", nargs="+", required=True)
    models.add_argument("--as-of", type=dt.date.fromisoformat)
    smoke = sub.add_parser("smoke")
    checked = smoke.add_mutually_exclusive_group(required=True)
    checked.add_argument("--table")
    checked.add_argument("--source", help="a raw source by name; needs --raw-root")
    smoke.add_argument("--min-rows", type=int, default=1)
    smoke.add_argument("--limit", type=int, default=5)
    return p.parse_args(argv)


def main(argv: list[str] | None = None) -> int:
    args = parse_args(argv)
    logging.basicConfig(level=logging.INFO)
    conf = session_conf(args.profile, checkpoint_dir=args.checkpoint_dir)
    spark = build_session(f"build-{args.what}", conf)
    cfg = EnvConfig(
        env=args.env,
        catalog=args.catalog,
        curated_root=args.curated_root,
        sources=default_sources(args.raw_root) if args.raw_root else (),
        enable_sales_orders=not args.no_sales_orders,
    )
    try:
        if args.what == "smoke":
            if args.source:
                source = source_named(enabled_sources(cfg), args.source)
                result = smoke_check_source(spark, source, limit=args.limit)
            else:
                result = smoke_check(spark, args.table, min_rows=args.min_rows, limit=args.limit)
            log.info("%s", result)
            return result.code
        if args.what == "models":
            log.info("built %s", run_models(spark, cfg, args.tags, as_of=args.as_of))
            return 0
        done = run_layers(spark, cfg, args.from_layer, args.to_layer, dry_run=args.dry_run)
        for layer, outcome in done.items():
            log.info("%s: %s", layer, outcome)
    except Exception:
        log.exception("%s failed", args.what)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
