import datetime as dt
import threading
import time
import uuid

import pytest
from conftest import at
from pyspark.sql import functions as F

from stratiform import EnvConfig
from stratiform.jobs import build
from stratiform.jobs import copy_table as copy_job
from stratiform.operators import QualityError
from stratiform.plans import (
    fct_orders_daily,
    graph,
    read_daily,
    run_layers,
    run_models,
    selected,
    stg_orders,
)
from stratiform.plans.graph import MODELS
from stratiform.plans.layers import LAYERS, layer_range
from stratiform.sinks import ensure_namespace, set_guard
from stratiform.sources import PartitionFilterRequired, RawSource, land_raw

TODAY = dt.date(2024, 1, 10)


@pytest.fixture
def env(spark, tmp_path, raw):
    """An environment with landed raw data and namespaces below the test's folder."""
    root = str(tmp_path / "raw")

    def land(dataset, *rows):
        return land_raw(raw(*rows), root, "sales", dataset)

    def make(env="dev", **settings):
        cfg = EnvConfig(env=env, sandbox=uuid.uuid4().hex[:8], **settings)
        for layer in ("curated", "analytics", "enterprise"):
            ensure_namespace(spark, cfg.namespace(layer), f"{tmp_path}/{cfg.namespace(layer)}")
        return cfg

    make.land = land
    make.sources = build.default_sources(root)
    land("sample", (1, "alex", 10.5, at("2024-01-01")), (2, "kim", 20.0, at("2024-01-02")))
    land(
        "orders",
        (1, "ann", 1.0, at("2024-01-01")),
        (2, None, 2.0, at("2024-01-09")),
        (None, "ann", 9.0, at("2024-01-09")),
    )
    land("sales_transactions", (7, "ann", 1.0, at("2024-01-01")))
    return make


def tables(spark, namespace):
    """Published names, not the versions behind them."""
    listed = [t.name for t in spark.catalog.listTables(namespace) if not t.isTemporary]
    return [name for name in listed if "__" not in name]


def test_layer_ranges():
    assert layer_range() == LAYERS
    assert layer_range("02_curated", "03_gold") == ("02_curated", "03_gold")
    with pytest.raises(ValueError, match="after"):
        layer_range("03_gold", "02_curated")
    with pytest.raises(ValueError, match="unknown"):
        layer_range("04_platinum")


def test_layers(spark, env):
    cfg = env("staging", sources=env.sources)
    done = run_layers(spark, cfg)
    assert list(done) == list(LAYERS) and done["99_quality"] == "passed"
    assert spark.table(done["01_external"]).count() == 2
    curated = spark.table(done["02_curated"])
    assert curated.columns == ["id", "name", "amount", "ts", "ingestion_ts", "source_object", "env"]
    gold = {r.name: r for r in spark.table(done["03_gold"]).collect()}
    assert gold["kim"].nb_rows == 1 and gold["kim"].env == "staging"
    properties = spark.sql(f"SHOW TBLPROPERTIES {done['03_gold']}").collect()
    assert {r.key: r.value for r in properties}["layer"] == "gold"
    assert run_layers(spark, cfg, "03_gold", "03_gold") == {"03_gold": done["03_gold"]}


def test_dry_run_writes_nothing(spark, env):
    cfg = env(sources=env.sources)
    plans = run_layers(spark, cfg, dry_run=True)
    assert list(plans) == list(LAYERS)
    assert all("Physical Plan" in p for p in plans.values())
    assert tables(spark, cfg.namespace("curated")) == []


def test_a_failed_check_stops_the_layers(spark, env):
    cfg = env(sources=env.sources)
    env.land("sample", (None, "no id", 1.0, None))
    with pytest.raises(QualityError, match="id contains NULLs"):
        run_layers(spark, cfg)
    assert tables(spark, cfg.namespace("curated")) == ["ext_sample_parquet"]


def test_cross_layer_checks_run_last(spark, env):
    cfg = env(sources=env.sources)
    env.land("sample", (3, "debt", -1.0, None))
    with pytest.raises(QualityError, match="negative amounts"):
        run_layers(spark, cfg)
    assert spark.catalog.tableExists(cfg.table("curated", "amount_by_name_gold"))


def test_selection_by_tag():
    prod = [m.name for m in selected(["prod"])]
    assert set(prod) == set(MODELS) - {
        "assert_stg_sample_not_null",
        "assert_enterprise_keys",
        "assert_raw_orders_not_null",
        "src_curated_customers_iceberg",
    }
    for model in selected(["prod"]):
        assert all(
            prod.index(p) < prod.index(model.name) for p in model.parents if p in prod
        )
    assert {m.name for m in selected(["dev"])} == {
        "src_raw_orders",
        "op_disable_rpf_fct_orders_daily",
    }
    assert {m.name for m in selected(["dq"])} == {
        "assert_orders_not_null",
        "assert_stg_sample_not_null",
    }


def test_production_run_twice(spark, env):
    cfg = env("prod", sources=env.sources, enable_sales_orders=True)
    done = run_models(spark, cfg, ["prod"], as_of=TODAY)
    assert "dim_customers" in done
    daily = cfg.table("analytics", "fct_orders_daily")
    published = cfg.table("enterprise", "enterprise_orders_daily")
    assert spark.table(daily).count() == 2
    assert spark.table(MODELS["int_orders_enriched"].address(cfg)).count() == 2
    assert spark.table(MODELS["hello"].address(cfg)).first().one == 1

    env.land("orders", (3, None, 3.0, at("2024-01-09")), (4, "old", 4.0, at("2023-12-01")))
    run_models(spark, cfg, ["prod"], as_of=TODAY)
    rows = {(r.order_date, r.customer_id): r.nb_orders for r in spark.table(daily).collect()}
    assert rows == {(dt.date(2024, 1, 1), "ann"): 1, (dt.date(2024, 1, 9), None): 2}
    assert spark.table(published).count() == 2
    assert spark.table(cfg.table("analytics", "dim_customers")).count() == 2

    with pytest.raises(PartitionFilterRequired):
        read_daily(spark, cfg)
    assert read_daily(spark, cfg, F.col("order_date") > dt.date(2024, 1, 5)).count() == 1
    assert read_daily(spark, cfg, guard=False).count() == 2


def test_development_run_needs_no_other_model(spark, env):
    cfg = env(sources=env.sources, enable_sales_orders=True)
    assert set(run_models(spark, cfg, ["dev"])) == {
        "src_raw_orders",
        "op_disable_rpf_fct_orders_daily",
    }
    assert spark.table(MODELS["src_raw_orders"].address(cfg)).count() == 3
    assert tables(spark, cfg.namespace("analytics")) == ["src_raw_orders"]


def test_views_are_there_for_other_sessions(spark, env):
    """Also for rows that land after the run, and with the casts of the models."""
    cfg = env("prod", sources=env.sources, enable_sales_orders=True)
    run_models(spark, cfg, ["prod"], as_of=TODAY)
    other = spark.newSession()
    clocks = ("load_ts", "ingestion_ts", "enriched_ts")
    for name, model in MODELS.items():
        if model.kind == "view" and "prod" in model.tags:
            seen, built = other.table(model.address(cfg)), model.build(_run(spark, cfg))
            assert seen.dtypes == built.dtypes, name
            rows = [sorted(map(str, d.drop(*clocks).collect())) for d in (seen, built)]
            assert rows[0] == rows[1], name
    assert other.sql(f"SELECT * FROM {MODELS['zz_env_check'].address(cfg)}").first().env == "prod"
    run_models(spark, cfg, ["prod"], as_of=TODAY)  # the texts are replaced
    text = spark.sql(f"SHOW CREATE TABLE {MODELS['stg_orders'].address(cfg)}").first()[0]
    assert cfg.namespace("raw_ext") in text


def test_a_view_of_other_views_makes_them_if_need_be(spark, env):
    cfg = env(sources=env.sources, enable_sales_orders=True)
    run_models(spark, cfg, ["intermediate"])
    assert spark.newSession().table(MODELS["int_orders_enriched"].address(cfg)).count() == 2
    assert "stg_orders" in tables(spark, cfg.namespace("analytics"))


def test_the_guard_of_the_daily_fact(spark, env):
    """On in production for every session, lifted in development by the operation."""
    prod = env("prod", sources=env.sources, enable_sales_orders=True)
    run_models(spark, prod, ["prod"], as_of=TODAY)
    with pytest.raises(PartitionFilterRequired):
        read_daily(spark.newSession(), prod)
    run_models(spark, prod, ["bootstrap"])
    with pytest.raises(PartitionFilterRequired):
        read_daily(spark.newSession(), prod)
    dev = env("dev", sources=env.sources, enable_sales_orders=True)
    run_models(spark, dev, ["prod"], as_of=TODAY)
    assert read_daily(spark.newSession(), dev).count() == 2
    set_guard(spark, dev.table("analytics", "fct_orders_daily"), True)
    with pytest.raises(PartitionFilterRequired):
        read_daily(spark.newSession(), dev)
    run_models(spark, dev, ["bootstrap"])
    assert read_daily(spark.newSession(), dev).count() == 2


def test_rows_that_come_ten_days_late(spark, env):
    """They change their day and no other, and the fact equals a full build."""
    cfg = env(sources=env.sources, enable_sales_orders=True, late_rows=True)
    daily = MODELS["fct_orders_daily"].address(cfg)

    def files():
        return {path for path in spark.table(daily).inputFiles()}

    def rows():
        return sorted(map(tuple, spark.table(daily).collect()), key=str)

    run_models(spark, cfg, ["prod"], as_of=TODAY)
    before, first = rows(), files()
    run_models(spark, cfg, ["prod"], as_of=TODAY)
    assert rows() == before and files() == first  # no new files, nothing rewritten
    env.land("orders", (8, "late", 8.0, at("2023-12-31")), (9, "ann", 9.0, at("2024-01-01")))
    env.land("orders", (10, "nowhen", 1.0, None))
    with pytest.raises(QualityError, match="assert_orders_not_null"):
        run_models(spark, cfg, ["prod"], as_of=TODAY)
    full = fct_orders_daily(stg_orders(_run(spark, cfg).raw("orders")))
    assert rows() == sorted(map(tuple, full.select(*spark.table(daily).columns).collect()), key=str)
    kept = {f for f in first if "order_date=2024-01-09" in f}
    assert kept and kept <= files()
    assert not {f for f in first if "order_date=2024-01-01" in f} & files()


def test_a_late_run_that_died_is_done_again(spark, env, monkeypatch):
    cfg = env(sources=env.sources, enable_sales_orders=True, late_rows=True)
    run_models(spark, cfg, ["prod"], as_of=TODAY)
    env.land("orders", (8, "late", 8.0, at("2023-12-31")))
    monkeypatch.setattr("stratiform.sources.ledger.append_table", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run_models(spark, cfg, ["prod"], as_of=TODAY)
    monkeypatch.undo()
    run_models(spark, cfg, ["prod"], as_of=TODAY)
    assert spark.table(MODELS["fct_orders_daily"].address(cfg)).count() == 3


def test_models_run_side_by_side(spark, env, monkeypatch):
    """Two that do not depend on each other are inside at once, and parents come first."""
    cfg = env("prod", sources=env.sources, enable_sales_orders=True)
    meet, real, order = threading.Barrier(2), graph._materialise, []

    def watched(run, model):
        if model.name in ("stg_sample", "dim_customers"):
            meet.wait(timeout=120)
        real(run, model)
        order.append(model.name)

    monkeypatch.setattr(graph, "_materialise", watched)
    done = run_models(spark, cfg, ["prod"], as_of=TODAY)
    assert set(done) == {m.name for m in selected(["prod"])} == set(order)
    for name in done:
        assert all(order.index(p) < order.index(name) for p in MODELS[name].parents if p in order)


def test_an_error_stops_the_models_beside(spark, env, monkeypatch):
    cfg = env("prod", sources=env.sources, enable_sales_orders=True)
    begun, real, ended = threading.Event(), graph._materialise, []

    def watched(run, model):
        if model.name == "stg_sample":
            begun.set()
            try:
                run.spark.range(0, 10**14, 1, 8).selectExpr("max(hash(id))").collect()
            finally:
                ended.append(model.name)
        if model.name == "stg_customers":
            begun.wait(timeout=60)
            time.sleep(2)
            raise QualityError("stop here")
        return real(run, model)

    monkeypatch.setattr(graph, "_materialise", watched)
    started = time.monotonic()
    with pytest.raises(QualityError, match="stop here"):
        run_models(spark, cfg, ["prod"], as_of=TODAY)
    assert time.monotonic() - started < 60 and ended == ["stg_sample"]
    assert not spark.sparkContext.statusTracker().getActiveJobsIds()
    assert "dim_customers" not in tables(spark, cfg.namespace("analytics"))


@pytest.mark.parametrize(
    "row, name",
    [
        ((None, "ann", 1.0, at("2024-01-02")), "assert_raw_orders_not_null"),
        ((5, None, 1.0, at("2024-01-02")), "assert_enterprise_keys"),
        ((5, "ann", 1.0, None), "assert_orders_not_null"),
    ],
)
def test_each_assertion_can_fail_a_run(spark, env, raw, tmp_path, row, name):
    root = str(tmp_path / "other")
    for dataset in ("sample", "sales_transactions"):
        land_raw(raw((7, "ann", 1.0, at("2024-01-01"))), root, "sales", dataset)
    land_raw(raw((1, "ann", 1.0, at("2024-01-01"))), root, "sales", "orders")
    cfg = env("prod", sources=build.default_sources(root), enable_sales_orders=True)
    run_models(spark, cfg, ["prod", "dq", "dq_strict"], as_of=TODAY)
    land_raw(raw(row), root, "sales", "orders")
    later = EnvConfig("prod", sandbox=cfg.sandbox + "b", sources=cfg.sources, enable_sales_orders=True)
    with pytest.raises(QualityError, match=name):
        run_models(spark, later, ["prod", "dq", "dq_strict"], as_of=TODAY)


def test_assertions_fail_the_run(spark, env):
    cfg = env(sources=env.sources, enable_sales_orders=True)
    run_models(spark, cfg, ["prod"], as_of=TODAY)
    run_models(spark, cfg, ["dq"], as_of=TODAY)
    env.land("sample", (9, None, 1.0, None))
    run_models(spark, cfg, ["prod"], as_of=TODAY)
    with pytest.raises(QualityError, match="assert_stg_sample_not_null"):
        run_models(spark, cfg, ["dq"])


def test_optional_sources_are_absent_unless_enabled(spark, env):
    cfg = env(sources=env.sources)
    with pytest.raises(KeyError, match="orders"):
        run_models(spark, cfg, ["dev"])


def test_curated_source_model(spark, env, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/curated/customer")
    cfg = env(curated_root=f"{tmp_path}/curated")
    assert MODELS["src_curated_customers_iceberg"].build(_run(spark, cfg)).count() == 3


def _run(spark, cfg):
    from stratiform.plans.graph import Run

    return Run(spark, cfg)


def test_copy_table(spark, namespace):
    source, target = f"{namespace}.numbers", f"{namespace}.copied"
    spark.range(5).write.saveAsTable(source)
    assert copy_job.copy_table(spark, source, target).count() == 5
    assert copy_job.copy_table(spark, source, target, "append").count() == 10
    assert copy_job.copy_table(spark, source, target).count() == 5
    assert copy_job.copy_table(spark, spark.range(2), target).count() == 2
    with pytest.raises(copy_job.CatalogNotConfigured):
        copy_job.copy_table(spark, source, "nowhere.ns.t")


def test_copy_job_exit_codes(spark, namespace):
    source = f"{namespace}.numbers"
    spark.range(5).write.saveAsTable(source)
    args = ["--source", source, "--namespace", namespace, "--table", "out"]
    assert copy_job.main([*args, "--catalog", "spark_catalog"]) == 0
    assert spark.table(f"{namespace}.out").count() == 5
    assert copy_job.main([*args, "--catalog", "nowhere"]) == 2
    args[1] = f"{namespace}.missing"
    assert copy_job.main([*args, "--catalog", "spark_catalog"]) == 1
    with pytest.raises(SystemExit):
        copy_job.parse_args([*args, "--catalog", "c", "--mode", "merge"])


def test_build_job(spark, tmp_path, env):
    root = str(tmp_path / "raw")
    assert build.main(["--raw-root", root, "layers", "--dry-run"]) == 0
    assert build.main(["--raw-root", f"{root}/none", "layers", "--dry-run"]) == 1
    assert build.main(["smoke", "--table", "nowhere.t"]) == 2
    assert build.main(["--raw-root", root, "smoke", "--source", "sample_ext"]) == 0
    assert build.main(["--raw-root", f"{root}/none", "smoke", "--source", "sample_ext"]) == 2
    sized = build.parse_args(["--profile", "dev_tiny", "--checkpoint-dir", "/x", "layers"])
    assert (sized.profile, sized.checkpoint_dir) == ("dev_tiny", "/x")
    args = build.parse_args(["--env", "prod", "models", "--tags", "prod", "--as-of", "2024-01-10"])
    assert args.as_of == TODAY and args.tags == ["prod"]
    with pytest.raises(SystemExit):
        build.parse_args(["--env", "test", "layers"])


def test_source_names_follow_the_landing_layout():
    sources = build.default_sources("s3a://raw")
    assert sources[0] == RawSource("sample_ext", ("s3a://raw/domain=sales/dataset=sample",))
