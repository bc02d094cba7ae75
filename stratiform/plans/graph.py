"""The models with their parents, and runs of those that carry a tag."""

from __future__ import annotations

import datetime as dt
import logging
import threading
import uuid
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass
from graphlib import TopologicalSorter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.util import inheritable_thread_target

from stratiform.config import EnvConfig
from stratiform.operators import checks
from stratiform.operators.checks import assert_no_rows
from stratiform.plans import late, marts, staging, views
from stratiform.session import prepare, size_shuffles_for
from stratiform.sinks import ensure_namespace, publish_table, set_guard, upsert_partitions
from stratiform.sources import env_check, one_row, read_curated, read_partitioned
from stratiform.sources.catalog import raw_name, read_declared
from stratiform.sources.registry import enabled_sources, source_named

log = logging.getLogger(__name__)

VIEW, TABLE, INCREMENTAL, ASSERTION, OPERATION = (
    "view",
    "table",
    "incremental",
    "assertion",
    "operation",
)


class Run:
    """One run: resolves what a model reads and remembers the views it built."""

    def __init__(
        self, spark: SparkSession, cfg: EnvConfig, as_of: dt.date | Column | None = None
    ) -> None:
        self.spark, self.cfg, self.as_of = prepare(spark), cfg, as_of
        self._views: dict[str, DataFrame] = {}
        self._raw: dict[str, DataFrame] = {}
        self._lock = threading.RLock()

    def raw(self, name: str) -> DataFrame:
        """A raw source, by way of its catalog table; brought up to date once in a run."""
        with self._lock:
            if name not in self._raw:
                source = source_named(enabled_sources(self.cfg), name)
                self._raw[name] = read_declared(self.spark, self.cfg, source)
            return self._raw[name]

    def raw_relation(self, name: str) -> tuple[T.StructType, str]:
        """Columns and name of the table of a raw source, for the text of a view."""
        frame = self.raw(name)
        return frame.schema, raw_name(self.cfg, source_named(enabled_sources(self.cfg), name))

    def ref(self, name: str) -> DataFrame:
        """A view is evaluated from its parents, a table is read from the catalog."""
        model = MODELS[name]
        if model.kind != VIEW:
            return self.spark.table(model.address(self.cfg))
        with self._lock:
            if name not in self._views:
                self._views[name] = model.build(self)
            return self._views[name]

    def view_relation(self, name: str) -> str:
        """Name of the view of a model, which is created if it does not exist yet."""
        model = MODELS[name]
        address = model.address(self.cfg)
        with self._lock:
            if not self.spark.catalog.tableExists(address):
                create_view(self, model)
        return address


@dataclass(frozen=True)
class Model:
    name: str
    kind: str
    tags: frozenset[str]
    build: Callable[[Run], DataFrame | None]
    parents: tuple[str, ...] = ()
    layer: str = "analytics"
    partition_by: tuple[str, ...] = ()
    cluster_by: tuple[str, ...] = ()
    bucket_by: tuple[str, ...] = ()
    keys: tuple[str, ...] = ()
    text: Callable[[Run], str] | None = None  # of a view

    def address(self, cfg: EnvConfig) -> str:
        if self.kind == VIEW:
            return views.view_name(cfg, self.layer, self.name)
        return cfg.table(self.layer, self.name)


def create_view(run: Run, model: Model) -> str:
    labels = {"layer": model.layer, "env": run.cfg.env}
    return views.create_view(run.spark, model.address(run.cfg), model.text(run), labels)


def _daily(run: Run) -> DataFrame:
    """A first run builds all days, later ones the look-back window."""
    built = run.spark.catalog.tableExists(MODELS["fct_orders_daily"].address(run.cfg))
    return marts.fct_orders_daily(run.ref("stg_orders"), incremental=built, as_of=run.as_of)


def _lift_guard(run: Run, name: str) -> None:
    """In development, reads of the table need no partition filter any more.

    The operation comes before the model it alters, so on a first run there is no table yet;
    the model is then made without the guard.
    """
    table = MODELS[name].address(run.cfg)
    if run.cfg.env == "dev" and not run.cfg.catalog and run.spark.catalog.tableExists(table):
        set_guard(run.spark, table, False)


def _model(name, kind, tags, build, *parents, **layout) -> Model:
    return Model(name, kind, frozenset(tags.split()), build, parents, **layout)


MODELS: Mapping[str, Model] = {
    m.name: m
    for m in (
        _model(
            "src_raw_orders",
            VIEW,
            "dev prod views",
            lambda run: staging.src_raw_orders(run.raw("orders")),
            text=lambda run: views.src_raw_orders(*run.raw_relation("orders")),
        ),
        _model(
            "src_curated_customers_iceberg",
            VIEW,
            "staging",
            lambda run: read_curated(run.spark, run.cfg, "customer"),
            text=lambda run: views.curated(run.cfg, "customer"),
        ),
        _model(
            "stg_orders",
            VIEW,
            "staging prod views",
            lambda run: staging.stg_orders(run.raw("orders")),
            text=lambda run: views.stg_orders(*run.raw_relation("orders")),
        ),
        _model(
            "stg_customers",
            VIEW,
            "staging prod views",
            lambda run: staging.stg_customers(run.raw("orders")),
            text=lambda run: views.stg_customers(*run.raw_relation("orders")),
        ),
        _model(
            "stg_sales_transactions",
            VIEW,
            "staging prod views",
            lambda run: staging.stg_sales_transactions(run.raw("sales_transactions")),
            text=lambda run: views.stg_sales_transactions(
                *run.raw_relation("sales_transactions")
            ),
        ),
        _model("stg_sample", TABLE, "prod", lambda run: staging.stg_sample(run.raw("sample_ext"))),
        _model(
            "int_orders_enriched",
            VIEW,
            "intermediate prod views",
            lambda run: marts.int_orders_enriched(
                run.ref("stg_orders"), run.ref("stg_sales_transactions")
            ),
            "stg_orders",
            "stg_sales_transactions",
            text=lambda run: views.int_orders_enriched(
                run.view_relation("stg_orders"), run.view_relation("stg_sales_transactions")
            ),
        ),
        _model(
            "dim_customers",
            TABLE,
            "prod",
            lambda run: marts.dim_customers(run.ref("stg_customers")),
            "stg_customers",
            bucket_by=("customer_id",),
        ),
        _model(
            "op_disable_rpf_fct_orders_daily",
            OPERATION,
            "prod bootstrap dev",
            lambda run: _lift_guard(run, "fct_orders_daily"),
        ),
        _model(
            "fct_orders_daily",
            INCREMENTAL,
            "prod fact",
            _daily,
            "stg_orders",
            "op_disable_rpf_fct_orders_daily",
            partition_by=("order_date",),
            keys=marts.FACT_KEYS,
        ),
        _model(
            "enterprise_orders_daily",
            TABLE,
            "prod",
            lambda run: marts.enterprise_orders_daily(run.ref("fct_orders_daily")),
            "fct_orders_daily",
            layer="enterprise",
            partition_by=("order_date",),
        ),
        # Staging drops orders without an id and keeps those without a customer, so what has
        # to be there in every run is the day. The stricter assertions have a tag of their own.
        _model(
            "assert_orders_not_null",
            ASSERTION,
            "dq prod",
            lambda run: checks.enterprise_null_rows(
                run.ref("enterprise_orders_daily"), ["order_date"]
            ),
            "enterprise_orders_daily",
        ),
        _model(
            "assert_enterprise_keys",
            ASSERTION,
            "dq_strict",
            lambda run: checks.enterprise_null_rows(run.ref("enterprise_orders_daily")),
            "enterprise_orders_daily",
        ),
        _model(
            "assert_raw_orders_not_null",
            ASSERTION,
            "dq_strict",
            lambda run: checks.order_null_rows(run.ref("src_raw_orders")),
            "src_raw_orders",
        ),
        _model(
            "assert_stg_sample_not_null",
            ASSERTION,
            "dq staging",
            lambda run: checks.sample_null_rows(run.ref("stg_sample")),
            "stg_sample",
        ),
        _model(
            "hello", VIEW, "prod", lambda run: one_row(run.spark), text=lambda run: views.one_row()
        ),
        _model(
            "zz_env_check",
            VIEW,
            "prod",
            lambda run: env_check(run.spark, run.cfg),
            text=lambda run: views.env_check(run.cfg),
        ),
    )
}


def selected(tags: Iterable[str]) -> list[Model]:
    """Models with any of the tags, parents before children.

    Parents without a selected tag are not pulled in: as views they are evaluated
    on the way, as tables they must have been built before.
    """
    wanted = set(tags)
    order = TopologicalSorter({m.name: m.parents for m in MODELS.values()}).static_order()
    return [MODELS[name] for name in order if MODELS[name].tags & wanted]


def run_models(
    spark: SparkSession,
    cfg: EnvConfig,
    tags: Iterable[str],
    *,
    as_of: dt.date | Column | None = None,
    side_by_side: int = 4,
) -> list[str]:
    """Materialise the selected models; returns their names as they were done.

    Models that do not depend on each other run side by side, each in a scheduler pool of its
    own, so a long one leaves room for the others where the session schedules fairly. The
    first failure cancels the Spark jobs of the others, starts no more and is raised.
    """
    run = Run(spark, cfg, as_of)
    models = {model.name: model for model in selected(tags)}
    order = TopologicalSorter({n: _parents(n, models) for n in models})
    order.prepare()
    done: list[str] = []
    running: dict[Future, str] = {}
    tag = f"run-{uuid.uuid4().hex}"
    with ThreadPoolExecutor(max_workers=side_by_side) as pool:
        try:
            while order.is_active():
                for name in order.get_ready():
                    step = inheritable_thread_target(spark)(_tagged)
                    running[pool.submit(step, run, models[name], tag)] = name
                finished, _ = wait(running, return_when=FIRST_COMPLETED)
                for future in finished:
                    name = running.pop(future)
                    future.result()
                    order.done(name)
                    done.append(name)
        except BaseException:
            for future in running:
                future.cancel()
            # A model between two of its jobs starts one more, so ask until all have ended.
            while running:
                spark.sparkContext.cancelJobsWithTag(tag)
                running = dict.fromkeys(wait(running, timeout=0.5).not_done)
            raise
    return done


def _parents(name: str, models: Mapping[str, Model]) -> set[str]:
    """The selected models that a model depends on, also by way of others."""
    found, waiting = set(), list(MODELS[name].parents)
    while waiting:
        parent = waiting.pop()
        if parent not in found:
            found.add(parent)
            waiting += MODELS[parent].parents
    return found & set(models)


def _tagged(run: Run, model: Model, tag: str) -> None:
    log.info("model %s (%s)", model.name, model.kind)
    run.spark.sparkContext.addJobTag(tag)
    run.spark.sparkContext.setLocalProperty("spark.scheduler.pool", model.name)
    try:
        _materialise(run, model)
    finally:
        run.spark.sparkContext.removeJobTag(tag)
        run.spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)


def _materialise(run: Run, model: Model) -> None:
    if model.kind == VIEW:
        create_view(run, model)
        return
    result = model.build(run)
    if model.kind == ASSERTION:
        size_shuffles_for(result)
        assert_no_rows(result, model.name)
        return
    if result is None:
        return
    size_shuffles_for(result)
    ensure_namespace(run.spark, ".".join(model.address(run.cfg).split(".")[:-1]))
    labels = {"layer": model.layer, "env": run.cfg.env}
    if model.kind == INCREMENTAL and run.cfg.late_rows and not run.cfg.catalog:
        late.load_new_files(
            source_named(enabled_sources(run.cfg), "orders"),
            run.ref("stg_orders"),
            model.address(run.cfg),
            run.cfg.table(model.layer, f"{model.name}_files"),
            properties=labels,
            require_partition_filter=run.cfg.require_partition_filter,
        )
        return
    if model.kind == INCREMENTAL:
        upsert_partitions(
            result,
            model.address(run.cfg),
            keys=model.keys,
            partition_col=model.partition_by[0],
            check_unique=False,  # grouped by these keys
            properties=labels,
            require_partition_filter=run.cfg.require_partition_filter,
        )
        return
    publish_table(
        result,
        model.address(run.cfg),
        partition_by=model.partition_by,
        cluster_by=model.cluster_by,
        bucket_by=model.bucket_by,
        properties=labels,
    )


def read_daily(
    spark: SparkSession, cfg: EnvConfig, where: Column | None = None, *, guard: bool | None = None
) -> DataFrame:
    """The daily fact for some days. Whether a filter on the day is required, the table says;
    ``guard`` overrules it."""
    table = MODELS["fct_orders_daily"].address(cfg)
    return read_partitioned(spark, table, where, require_filter=guard)
