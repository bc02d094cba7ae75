"""The layered run: raw scan, curated table, gold table, cross-layer checks."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession

from stratiform.config import EnvConfig
from stratiform.operators.checks import (
    cross_layer_checks,
    enforce,
    gold_checks,
    run_checks,
    sample_checks,
)
from stratiform.plans.curated import amount_by_name_gold, sample_curated
from stratiform.session import prepare, size_shuffles_for
from stratiform.sinks import ensure_namespace, publish_table
from stratiform.sources import preview, read_raw
from stratiform.sources.catalog import declare_raw
from stratiform.sources.readers import plan_text
from stratiform.sources.registry import source_named

log = logging.getLogger(__name__)

# Layer names in running order.
LAYERS = ("01_external", "02_curated", "03_gold", "99_quality")

SAMPLE_SOURCE = "sample_ext"


def layer_range(from_layer: str = LAYERS[0], to_layer: str = LAYERS[-1]) -> tuple[str, ...]:
    for name in (from_layer, to_layer):
        if name not in LAYERS:
            raise ValueError(f"unknown layer {name!r}, expected one of {LAYERS}")
    first, last = LAYERS.index(from_layer), LAYERS.index(to_layer)
    if first > last:
        raise ValueError(f"{from_layer} comes after {to_layer}")
    return LAYERS[first : last + 1]


def run_layers(
    spark: SparkSession,
    cfg: EnvConfig,
    from_layer: str = LAYERS[0],
    to_layer: str = LAYERS[-1],
    *,
    dry_run: bool = False,
) -> dict[str, str]:
    """Run a range of layers in order; the first failure stops the run.

    Returns the name of what each layer made. A dry run writes nothing and returns
    the query plan of each layer instead.
    """
    prepare(spark)
    layers = layer_range(from_layer, to_layer)
    if dry_run:
        return {layer: plan_text(_LAYER_PLANS[layer](spark, cfg)) for layer in layers}
    ensure_namespace(spark, _namespace(cfg))
    done = {}
    for layer in layers:
        log.info("layer %s", layer)
        done[layer] = _LAYER_RUNS[layer](spark, cfg)
    return done


def _namespace(cfg: EnvConfig) -> str:
    return cfg.table("curated", "x").rsplit(".", 1)[0]


def _raw(spark: SparkSession, cfg: EnvConfig) -> DataFrame:
    return read_raw(spark, source_named(cfg.sources, SAMPLE_SOURCE))


def _curated_table(cfg: EnvConfig) -> str:
    return cfg.table("curated", "sample_curated")


def _gold_table(cfg: EnvConfig) -> str:
    return cfg.table("curated", "amount_by_name_gold")


def _curated(spark: SparkSession, cfg: EnvConfig) -> DataFrame:
    return sample_curated(_raw(spark, cfg), cfg.env)


def _gold(spark: SparkSession, cfg: EnvConfig) -> DataFrame:
    table = _curated_table(cfg)
    published = spark.catalog.tableExists(table)
    curated = spark.table(table) if published else _curated(spark, cfg)
    return amount_by_name_gold(curated, cfg.env)


def quality_report(curated: DataFrame, gold: DataFrame) -> DataFrame:
    """The cross-layer checks of both tables, one pass over each."""
    by_table = cross_layer_checks()
    return run_checks(curated, by_table["sample_curated"]).unionAll(
        run_checks(gold, by_table["amount_by_name_gold"])
    )


def _quality(spark: SparkSession, cfg: EnvConfig) -> DataFrame:
    if spark.catalog.tableExists(_gold_table(cfg)):
        return quality_report(spark.table(_curated_table(cfg)), spark.table(_gold_table(cfg)))
    return quality_report(_curated(spark, cfg), _gold(spark, cfg))


def _run_external(spark: SparkSession, cfg: EnvConfig) -> str:
    """The raw sample as an external table, which stays when the session ends."""
    name = f"{cfg.namespace('curated')}.ext_sample_parquet"
    declare_raw(spark, source_named(cfg.sources, SAMPLE_SOURCE), name)
    preview(spark.table(name), 10).collect()
    return name


def _run_curated(spark: SparkSession, cfg: EnvConfig) -> str:
    table = _curated_table(cfg)
    publish_table(
        size_shuffles_for(_curated(spark, cfg)),
        table,
        checks=sample_checks(),
        comment="Typed sample with lineage columns.",
        properties={"layer": "curated", "env": cfg.env},
    )
    return table


def _run_gold(spark: SparkSession, cfg: EnvConfig) -> str:
    table = _gold_table(cfg)
    publish_table(
        size_shuffles_for(amount_by_name_gold(spark.table(_curated_table(cfg)), cfg.env)),
        table,
        checks=gold_checks(),
        comment="Amounts and time span per name.",
        properties={"layer": "gold", "env": cfg.env},
    )
    return table


def _run_quality(spark: SparkSession, cfg: EnvConfig) -> str:
    enforce(_quality(spark, cfg))
    return "passed"


_LAYER_PLANS = dict(zip(LAYERS, (_raw, _curated, _gold, _quality), strict=True))
_LAYER_RUNS = dict(
    zip(LAYERS, (_run_external, _run_curated, _run_gold, _run_quality), strict=True)
)
