"""Queries over the given tables and the SQL each must agree with."""

from __future__ import annotations

import datetime as dt
import importlib.util
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.config import EnvConfig
from stratiform.functions import INT64, NUMERIC, STRING, TIMESTAMP, safe, strict
from stratiform.jobs.copy_table import copy_table
from stratiform.operators import checks, smoke_frame
from stratiform.plans import (
    amount_by_name_gold,
    dim_customers,
    enterprise_orders_daily,
    fct_orders_daily,
    int_orders_enriched,
    quality_report,
    read_daily,
    run_layers,
    run_models,
    sample_curated,
    src_raw_orders,
    stg_customers,
    stg_orders,
    stg_sales_transactions,
    stg_sample,
)
from stratiform.plans.graph import MODELS
from stratiform.plans.adapters import (
    raw_orders,
    raw_sales_transactions,
    raw_sample,
    raw_sample_dirty,
    table,
)
from stratiform.session import fresh_path, prepare, size_shuffles
from stratiform.sinks import (
    append_table,
    ensure_namespace,
    publish_table,
    upsert_partitions,
    write_partitioned,
)
from stratiform.sources import (
    RawSource,
    declare_sources,
    land_raw,
    landing_path,
    preview,
    read_curated,
    read_partitioned,
    read_query,
    read_raw,
)

# The training-data operators can be taken out as a whole; all else here does without.
_LLM = all(importlib.util.find_spec(m) for m in ("stratiform.llm", "corpus_pipeline"))
if _LLM:
    import corpus_pipeline
    from stratiform.llm import queries as llm_queries

AS_OF = dt.date(2001, 8, 1)
RANGE = (dt.date(1998, 1, 1), dt.date(1998, 3, 31))
EVENTS_FROM = dt.date(2024, 1, 10)
LATE_DAYS = (dt.date(1995, 3, 1), dt.date(1995, 3, 31))
CLOCKS = ("load_ts", "ingestion_ts", "ingested_at", "enriched_ts", "built_ts")

RAW_SCHEMA = "id BIGINT, name STRING, amount DOUBLE, event_ts TIMESTAMP"


def _no_clock(df: DataFrame) -> DataFrame:
    return df.drop(*CLOCKS)


def _sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw sample with an instant as timestamp, as files with a zone hold it."""
    return raw_sample(spark, sf_dir).withColumn("event_ts", F.col("event_ts").cast("timestamp"))


def entry(spark: SparkSession) -> DataFrame:
    """Daily fact: orders and amount per day and customer."""
    return _fct_orders_daily(spark, "/root/testdata/sf0.001")


# --- sources -----------------------------------------------------------------


def _raw_scan(spark, sf_dir):
    source = RawSource("events_raw", (f"{sf_dir}/event[s].parquet",))
    return read_raw(spark, source)


def _landed(spark, sf_dir, file_format, name, schema):
    root = fresh_path(spark, f"land-{file_format.lower()}")
    land_raw(_sample(spark, sf_dir), root, "sales", "sample", file_format=file_format.lower())
    formats = {"csv": "CSV", "json": "NEWLINE_DELIMITED_JSON", "parquet": "PARQUET"}
    path = landing_path(root, "sales", "sample")
    return read_raw(spark, RawSource(name, (path,), formats[file_format], schema=schema))


def _scan_csv(spark, sf_dir):
    return _landed(spark, sf_dir, "csv", "sample_csv", RAW_SCHEMA)


def _scan_json(spark, sf_dir):
    return _landed(spark, sf_dir, "json", "sample_json", RAW_SCHEMA)


def _land_and_scan(spark, sf_dir):
    return _landed(spark, sf_dir, "parquet", "sample_ext", None)


def _scan_hive_partitions(spark, sf_dir):
    root = fresh_path(spark, "land-hive")
    dated = _sample(spark, sf_dir).withColumn("ingest_date", F.to_date("event_ts"))
    arranged = dated.hint("rebalance", F.col("ingest_date"))
    land_raw(arranged, root, "sales", "sample", partition_by=["ingest_date"])
    source = RawSource(
        "sample_ext", (f"{landing_path(root, 'sales', 'sample')}/*/*.parquet",), base_path=root
    )
    return read_raw(spark, source)


def _raw_table(spark, sf_dir):
    cfg = _sandbox(spark, "dev", sources=(RawSource("events", (f"{sf_dir}/event[s].parquet",)),))
    return _elsewhere(spark, declare_sources(spark, cfg)[0])


def _raw_table_partitions(spark, sf_dir):
    """A table over folders by day, of which a filter on the day lists only those it needs."""
    root = fresh_path(spark, "land-days")
    dated = _sample(spark, sf_dir).withColumn("ingest_date", F.to_date("event_ts"))
    path = land_raw(dated.repartition(8, "ingest_date"), root, "sales", "sample", partition_by=["ingest_date"])
    source = RawSource("sample_ext", (f"{path}/*/*.parquet",), base_path=root)
    name = declare_sources(spark, _sandbox(spark, "dev", sources=(source,)))[0]
    return _elsewhere(spark, name).where(F.col("ingest_date") >= F.lit(EVENTS_FROM))


def _curated_passthrough(spark, sf_dir):
    root = fresh_path(spark, "curated")
    write_partitioned(table(spark, sf_dir, "customer"), f"{root}/customer")
    return read_curated(spark, EnvConfig(curated_root=root), "customer")


def _query_source(spark, sf_dir):
    _sample(spark, sf_dir).createOrReplaceTempView("query_source_sample")
    return read_query(
        spark,
        "SELECT id, name, amount, event_ts FROM query_source_sample WHERE amount >= :least",
        args={"least": 10.0},
    )


def _preview(spark, sf_dir):
    return preview(_no_clock(stg_sample(_sample(spark, sf_dir))), 10)


# --- staging, curated, gold --------------------------------------------------


def _src_raw_orders(spark, sf_dir):
    return _no_clock(src_raw_orders(raw_orders(spark, sf_dir)))


def _orders(spark, sf_dir):
    return stg_orders(raw_orders(spark, sf_dir))


def _transactions(spark, sf_dir):
    return stg_sales_transactions(raw_sales_transactions(spark, sf_dir))


def _stg_orders(spark, sf_dir):
    return _no_clock(_orders(spark, sf_dir))


def _stg_sales_transactions(spark, sf_dir):
    return _no_clock(_transactions(spark, sf_dir))


def _stg_customers(spark, sf_dir):
    return _no_clock(stg_customers(raw_orders(spark, sf_dir)))


def _namespace(spark: SparkSession, label: str) -> str:
    """A namespace of its own for one query, with its files in the shared folder."""
    path = fresh_path(spark, label)
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    ensure_namespace(spark, name, path)
    return name


def _sandbox(spark: SparkSession, env: str, **settings) -> EnvConfig:
    """An environment of its own for one query."""
    cfg = EnvConfig(env=env, sandbox=uuid.uuid4().hex, **settings)
    for layer in ("raw_ext", "curated", "analytics", "enterprise"):
        ensure_namespace(spark, cfg.namespace(layer), fresh_path(spark, layer))
    return cfg


def _elsewhere(spark: SparkSession, name: str) -> DataFrame:
    """A table or view as another session over the same catalog finds it."""
    return prepare(spark.newSession()).table(name)


def _stg_sample(spark, sf_dir):
    namespace = _namespace(spark, "sample")
    return _no_clock(publish_table(stg_sample(_sample(spark, sf_dir)), f"{namespace}.stg_sample"))


def _curated(spark, sf_dir):
    return sample_curated(raw_sample_dirty(spark, sf_dir), "dev")


def _sample_curated(spark, sf_dir):
    return _no_clock(_curated(spark, sf_dir))


def _gold(spark, sf_dir):
    return _no_clock(amount_by_name_gold(sample_curated(_sample(spark, sf_dir), "dev"), "dev"))


def _gold_dirty(spark, sf_dir):
    return _no_clock(amount_by_name_gold(_curated(spark, sf_dir), "dev"))


def _casts_strict(spark, sf_dir):
    raw = table(spark, sf_dir, "orders")
    return raw.select(
        strict(raw, "o_orderkey", STRING).alias("order_text"),
        strict(raw, "o_totalprice", INT64).alias("whole_price"),
        strict(raw, "o_totalprice", NUMERIC).alias("price"),
        strict(raw, "o_orderdate", TIMESTAMP).alias("order_ts"),
    )


def _casts_safe(spark, sf_dir):
    raw = raw_sample_dirty(spark, sf_dir)
    return raw.select(
        safe(raw, "id", STRING).alias("id_text"),
        safe(raw, "id", INT64).alias("id"),
        safe(raw, "amount", NUMERIC).alias("amount"),
        safe(raw, "event_ts", TIMESTAMP).alias("event_ts"),
    )


# --- marts -------------------------------------------------------------------


def _int_orders_enriched(spark, sf_dir):
    return _no_clock(int_orders_enriched(_orders(spark, sf_dir), _transactions(spark, sf_dir)))


def _int_orders_enriched_in_cells(spark, sf_dir):
    """The same join with every key that has two transactions treated as hot."""
    joined = int_orders_enriched(_orders(spark, sf_dir), _transactions(spark, sf_dir), hot_rows=1)
    return _no_clock(joined)


def _dim_customers(spark, sf_dir):
    namespace = _namespace(spark, "dim")
    customers = stg_customers(raw_sales_transactions(spark, sf_dir))
    return publish_table(
        dim_customers(customers), f"{namespace}.dim_customers", bucket_by=["customer_id"]
    )


def _fct_orders_daily(spark, sf_dir):
    return fct_orders_daily(_orders(prepare(spark), sf_dir))


def _fct_orders_daily_window(spark, sf_dir):
    return fct_orders_daily(_orders(spark, sf_dir), incremental=True, as_of=AS_OF)


def _partitioned_fact(spark, sf_dir):
    path = fresh_path(spark, "fct")
    return write_partitioned(
        _fct_orders_daily(spark, sf_dir), path, partition_by=["order_date"]
    ), path


def _fct_round_trip(spark, sf_dir):
    return _partitioned_fact(spark, sf_dir)[0]


def _fct_by_date_range(spark, sf_dir):
    return read_partitioned(
        spark, _partitioned_fact(spark, sf_dir)[0], F.col("order_date").between(*RANGE)
    )


def _fct_orders_daily_late(spark, sf_dir):
    """The fact after a run that finds orders years older than its look-back.

    The first run knows no order of ``LATE_DAYS`` with an odd key; then these land.
    """
    root = fresh_path(spark, "raw-late")
    raw = raw_orders(spark, sf_dir)
    late = F.to_date("event_ts").between(*LATE_DAYS) & (F.coalesce("id", F.lit(1)) % 2 == 1)
    cfg = _sandbox(
        spark,
        "dev",
        sources=(RawSource("orders", (land_raw(raw.where(~late), root, "sales", "orders"),)),),
        enable_sales_orders=True,
        late_rows=True,
    )
    for rows in (None, raw.where(late)):
        if rows is not None:
            land_raw(rows, root, "sales", "orders")
        run_models(spark, cfg, ["fact"], as_of=AS_OF)
    return _elsewhere(spark, MODELS["fct_orders_daily"].address(cfg))


def _fct_orders_daily_table(spark, sf_dir):
    """The upsert of :func:`_fct_orders_daily_incremental` into a catalog table."""
    name = f"{_namespace(spark, 'fct-table')}.fct_orders_daily"
    return _earlier_and_later(spark, sf_dir, name)


def _fct_orders_daily_incremental(spark, sf_dir):
    """A table as an earlier run left it, brought up to date by a later run.

    The earlier run knew orders before the last day of the data only, at double the
    amount. The later run replaces the days of its window and leaves those before.
    """
    return _earlier_and_later(spark, sf_dir, fresh_path(spark, "fct-incremental"))


def _earlier_and_later(spark, sf_dir, target):
    keys = {"keys": ["order_date", "customer_id"], "partition_col": "order_date"}
    orders = _orders(spark, sf_dir)
    before = orders.where(F.col("order_date") < F.date_sub(F.lit(AS_OF), 2))
    doubled = before.withColumn("amount", (F.col("amount") * 2).cast(NUMERIC))
    upsert_partitions(fct_orders_daily(doubled), target, check_unique=False, **keys)
    window = fct_orders_daily(orders, incremental=True, as_of=AS_OF)
    return upsert_partitions(window, target, check_unique=False, **keys)


def _guarded_daily(spark, sf_dir):
    """Some days of a production table whose own property demands that they are named."""
    cfg = _sandbox(spark, "prod")
    publish_table(
        _fct_orders_daily(spark, sf_dir),
        cfg.table("analytics", "fct_orders_daily"),
        partition_by=["order_date"],
        require_partition_filter=cfg.require_partition_filter,
    )
    return read_daily(prepare(spark.newSession()), cfg, F.col("order_date").between(*RANGE))


def _views(spark, sf_dir) -> EnvConfig:
    """The view models over landed raw rows."""
    sources = _seeded(
        spark,
        sf_dir,
        orders=raw_orders(spark, sf_dir),
        sales_transactions=raw_sales_transactions(spark, sf_dir),
    )
    cfg = _sandbox(spark, "dev", sources=sources, enable_sales_orders=True)
    run_models(spark, cfg, ["views"])
    return cfg


def _view(name):
    def query(spark, sf_dir):
        return _no_clock(_elsewhere(spark, MODELS[name].address(_views(spark, sf_dir))))

    return query


def _enterprise_orders_daily(spark, sf_dir):
    namespace = _namespace(spark, "enterprise")
    return publish_table(
        enterprise_orders_daily(_fct_orders_daily(spark, sf_dir)),
        f"{namespace}.enterprise_orders_daily",
        partition_by=["order_date"],
    )


# --- sinks and jobs ----------------------------------------------------------


def _append_load(spark, sf_dir):
    name = f"{_namespace(spark, 'append')}.transactions"
    loaded = _stg_sales_transactions(spark, sf_dir)
    publish_table(loaded.where(F.col("order_date") < RANGE[0]), name)
    append_table(loaded.where(F.col("order_date") >= RANGE[0]), name)
    return spark.table(name)


def _copy_table(spark, sf_dir):
    namespace = _namespace(spark, "copy")
    customers = table(spark, sf_dir, "customer")
    publish_table(customers, f"{namespace}.customer")
    target = _namespace(spark, "copy-to")
    return copy_table(spark, f"{namespace}.customer", f"{target}.customer_copy")


def _seeded(spark, sf_dir, **datasets) -> tuple[RawSource, ...]:
    root = fresh_path(spark, "raw")
    return tuple(
        RawSource(name, (land_raw(df, root, "sales", name),)) for name, df in datasets.items()
    )


def _layered_run(spark, sf_dir):
    sources = _seeded(spark, sf_dir, sample_ext=_sample(spark, sf_dir))
    cfg = _sandbox(spark, "staging", sources=sources)
    return _no_clock(spark.table(run_layers(spark, cfg)["03_gold"]))


def _tagged_run(spark, sf_dir):
    """All models tagged for production; the enterprise table as it is published."""
    sources = _seeded(
        spark,
        sf_dir,
        sample_ext=_sample(spark, sf_dir),
        orders=raw_orders(spark, sf_dir),
        sales_transactions=raw_sales_transactions(spark, sf_dir),
    )
    cfg = _sandbox(spark, "prod", sources=sources, enable_sales_orders=True)
    run_models(spark, cfg, ["prod"], as_of=AS_OF)
    return spark.table(cfg.table("enterprise", "enterprise_orders_daily"))


# --- quality -----------------------------------------------------------------


def _assert_sample_not_null(spark, sf_dir):
    return checks.sample_null_rows(_curated(spark, sf_dir)).select("id", "name", "amount", "ts")


def _assert_orders_not_null(spark, sf_dir):
    return _no_clock(checks.order_null_rows(src_raw_orders(raw_orders(spark, sf_dir))))


def _assert_enterprise_keys(spark, sf_dir):
    return checks.enterprise_null_rows(enterprise_orders_daily(_fct_orders_daily(spark, sf_dir)))


def _int_orders_enriched_day(spark, sf_dir):
    """One day of the join: the day reaches the scans of both sides."""
    day = F.col("order_date") == F.lit(RANGE[0])
    orders, transactions = _orders(spark, sf_dir), _transactions(spark, sf_dir)
    return _no_clock(int_orders_enriched(orders, transactions, where=day))


def _quality_checks(spark, sf_dir):
    curated = _curated(spark, sf_dir)
    gold = amount_by_name_gold(curated, "dev")
    own = checks.run_checks(curated, checks.sample_checks())
    report = own.unionAll(checks.run_checks(gold, checks.gold_checks()))
    return report.unionAll(quality_report(curated, gold)).select("check_name", "failing", "passed")


def _smoke_check(spark, sf_dir):
    return smoke_frame(table(spark, sf_dir, "lineitem"), "lineitem")


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "raw_scan": _raw_scan,
    "scan_csv": _scan_csv,
    "scan_json": _scan_json,
    "scan_hive_partitions": _scan_hive_partitions,
    "land_and_scan": _land_and_scan,
    "raw_table": _raw_table,
    "raw_table_partitions": _raw_table_partitions,
    "curated_passthrough": _curated_passthrough,
    "query_source": _query_source,
    "preview": _preview,
    "src_raw_orders": _src_raw_orders,
    "stg_orders": _stg_orders,
    "stg_sales_transactions": _stg_sales_transactions,
    "stg_customers": _stg_customers,
    "src_raw_orders_view": _view("src_raw_orders"),
    "stg_orders_view": _view("stg_orders"),
    "stg_sales_transactions_view": _view("stg_sales_transactions"),
    "stg_customers_view": _view("stg_customers"),
    "int_orders_enriched_view": _view("int_orders_enriched"),
    "stg_sample": _stg_sample,
    "sample_curated": _sample_curated,
    "amount_by_name_gold": _gold,
    "amount_by_name_gold_dirty": _gold_dirty,
    "casts_strict": _casts_strict,
    "casts_safe": _casts_safe,
    "int_orders_enriched": _int_orders_enriched,
    "int_orders_enriched_in_cells": _int_orders_enriched_in_cells,
    "int_orders_enriched_day": _int_orders_enriched_day,
    "dim_customers": _dim_customers,
    "fct_orders_daily": _fct_orders_daily,
    "fct_orders_daily_window": _fct_orders_daily_window,
    "fct_orders_daily_round_trip": _fct_round_trip,
    "fct_by_date_range": _fct_by_date_range,
    "fct_orders_daily_incremental": _fct_orders_daily_incremental,
    "fct_orders_daily_table": _fct_orders_daily_table,
    "fct_orders_daily_late": _fct_orders_daily_late,
    "guarded_daily": _guarded_daily,
    "enterprise_orders_daily": _enterprise_orders_daily,
    "append_load": _append_load,
    "copy_table": _copy_table,
    "layered_run": _layered_run,
    "tagged_run": _tagged_run,
    "assert_sample_not_null": _assert_sample_not_null,
    "assert_orders_not_null": _assert_orders_not_null,
    "assert_enterprise_keys": _assert_enterprise_keys,
    "quality_checks": _quality_checks,
    "smoke_check": _smoke_check,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:

    def prepared(query):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return query(size_shuffles(prepare(spark), [sf_dir]), sf_dir.rstrip("/"))

        return run

    found = {name: prepared(query) for name, query in _QUERIES.items()}
    if _LLM:
        found |= {name: prepared(query) for name, query in llm_queries.QUERIES.items()}
        found["pipeline"] = prepared(corpus_pipeline.run)
    return found


_RAW_ORDERS = """
    select case when l_partkey % 97 = 0 then null else l_orderkey end as id,
           case when l_partkey % 89 = 0 then null
                else concat('cust-', cast(o_custkey // 75 as varchar)) end as name,
           l_extendedprice as amount,
           o_orderdate as event_ts
    from lineitem join orders on l_orderkey = o_orderkey
"""
_RAW_TRANSACTIONS = """
    select o_orderkey as id,
           concat('cust-', cast(o_custkey // 75 as varchar)) as name,
           o_totalprice as amount,
           o_orderdate as event_ts
    from orders
"""
_RAW_SAMPLE = """
    select event_id as id, event_type as name, value as amount, ts as event_ts from events
"""
_RAW_SAMPLE_DIRTY = """
    select case when event_id % 50 = 0 then concat('bad-', cast(event_id as varchar))
                else cast(event_id as varchar) end as id,
           case when event_id % 71 = 0 then null else event_type end as name,
           case when event_id % 60 = 0 then 'n/a'
                when event_id % 61 = 0 then concat('-', cast(value as varchar))
                else cast(value as varchar) end as amount,
           case when event_id % 70 = 0 then 'not a time' else cast(ts as varchar) end as event_ts
    from events
"""
_STG_ORDERS = """
    select cast(id as varchar) as order_id,
           name as customer_id,
           event_ts as order_timestamp,
           cast(event_ts as date) as order_date,
           cast(amount as decimal(38, 9)) as amount
    from raw_orders where id is not null
"""
_STG_TRANSACTIONS = """
    select cast(id as varchar) as transaction_id,
           event_ts as transaction_ts,
           cast(event_ts as date) as order_date,
           name as customer_id,
           name as product_id,
           cast(1 as bigint) as qty,
           cast(amount as decimal(38, 9)) as unit_price,
           cast(amount as decimal(38, 9)) as amount,
           'EUR' as currency,
           'FR' as country
    from raw_transactions where id is not null
"""
_CURATED = """
    select try_cast(id as bigint) as id,
           name,
           try_cast(amount as decimal(38, 9)) as amount,
           try_cast(event_ts as timestamp) as ts,
           'ext_sample_parquet' as source_object,
           'dev' as env
    from raw_sample
"""
_DAILY = """
    select order_date, customer_id,
           count(distinct order_id) as nb_orders, sum(amount) as total_amount
    from stg_orders group by order_date, customer_id
"""
_GOLD = """
    select name, count(*) as nb_rows, sum(amount) as total_amount,
           min(ts) as first_ts, max(ts) as last_ts, '{env}' as env
    from sample_curated group by name
"""
_CUSTOMERS = """
    select name as customer_id, name as customer_name, min(event_ts) as created_ts
    from {raw} where name is not null group by name
"""
_ENRICHED = """
    select order_id, customer_id, order_date, stg_orders.amount as order_amount,
           transaction_id, stg_transactions.amount as transaction_amount
    from stg_orders left join stg_transactions using (order_date, customer_id)
"""


def _with(last: str, **steps: str) -> str:
    return "with " + ", ".join(f"{k} as ({v})" for k, v in steps.items()) + last


def oracle_sql() -> dict[str, str]:
    """The same results in plain SQL; a preview without order has none."""
    orders = {"raw_orders": _RAW_ORDERS, "stg_orders": _STG_ORDERS}
    transactions = {"raw_transactions": _RAW_TRANSACTIONS, "stg_transactions": _STG_TRANSACTIONS}
    daily = _with(_DAILY, **orders)
    clean = {"raw_sample": _RAW_SAMPLE, "sample_curated": _CURATED}
    dirty = {"raw_sample": _RAW_SAMPLE_DIRTY, "sample_curated": _CURATED}
    gold_dirty = _GOLD.format(env="dev")
    start, end = (f"date '{d}'" for d in RANGE)
    today = f"date '{AS_OF}'"
    doubled = _with(
        f"""
        select order_date, customer_id, nb_orders,
               cast(case when order_date >= {today} - 7 then total_amount
                         else total_amount * 2 end as decimal(38, 9)) as total_amount
        from daily
        """,
        **orders,
        daily=_DAILY,
    )
    days = _with(
        f"select * from daily where order_date between {start} and {end}",
        **orders,
        daily=_DAILY,
    )
    customers = _with(_CUSTOMERS.format(raw="raw_orders"), raw_orders=_RAW_ORDERS)
    business_names = _with(
        """
        select cast(id as varchar) as order_id, name as order_name,
               cast(amount as decimal(38, 9)) as order_amount,
               event_ts as order_ts, 'raw_ext' as record_source
        from raw_orders
        """,
        raw_orders=_RAW_ORDERS,
    )
    extra = dict(llm_queries.ORACLE_SQL) if _LLM else {}
    if _LLM and corpus_pipeline.ORACLE_SQL:
        extra["pipeline"] = corpus_pipeline.ORACLE_SQL
    return extra | {
        "raw_scan": "select * from events",
        "scan_csv": _RAW_SAMPLE,
        "scan_json": _RAW_SAMPLE,
        "scan_hive_partitions": "select event_id as id, event_type as name, value as amount, "
        "ts as event_ts, 'sales' as domain, 'sample' as dataset, "
        "cast(ts as date) as ingest_date from events",
        "land_and_scan": _RAW_SAMPLE,
        "raw_table": "select * from events",
        "raw_table_partitions": "select event_id as id, event_type as name, value as amount, "
        "ts as event_ts, 'sales' as domain, 'sample' as dataset, "
        f"cast(ts as date) as ingest_date from events where ts >= date '{EVENTS_FROM}'",
        "curated_passthrough": "select * from customer",
        "query_source": f"select * from ({_RAW_SAMPLE}) where amount >= 10",
        "src_raw_orders": business_names,
        "src_raw_orders_view": business_names,
        "stg_orders_view": _with(_STG_ORDERS, raw_orders=_RAW_ORDERS),
        "stg_sales_transactions_view": _with(
            _STG_TRANSACTIONS, raw_transactions=_RAW_TRANSACTIONS
        ),
        "stg_customers_view": customers,
        "int_orders_enriched_view": _with(_ENRICHED, **orders, **transactions),
        "stg_orders": _with(_STG_ORDERS, raw_orders=_RAW_ORDERS),
        "stg_sales_transactions": _with(_STG_TRANSACTIONS, raw_transactions=_RAW_TRANSACTIONS),
        "stg_customers": customers,
        "stg_sample": _with(
            """
            select id, name, cast(amount as decimal(38, 9)) as amount, event_ts,
                   'raw_ext' as record_source
            from raw_sample
            """,
            raw_sample=_RAW_SAMPLE,
        ),
        "sample_curated": _with(_CURATED, raw_sample=_RAW_SAMPLE_DIRTY),
        "amount_by_name_gold": _with(_GOLD.format(env="dev"), **clean),
        "amount_by_name_gold_dirty": _with(gold_dirty, **dirty),
        "casts_strict": """
            select cast(o_orderkey as varchar) as order_text,
                   cast(round(o_totalprice) as bigint) as whole_price,
                   cast(o_totalprice as decimal(38, 9)) as price,
                   cast(o_orderdate as timestamp) as order_ts
            from orders
        """,
        "casts_safe": _with(
            """
            select cast(id as varchar) as id_text, try_cast(id as bigint) as id,
                   try_cast(amount as decimal(38, 9)) as amount,
                   try_cast(event_ts as timestamp) as event_ts
            from raw_sample
            """,
            raw_sample=_RAW_SAMPLE_DIRTY,
        ),
        "int_orders_enriched": _with(_ENRICHED, **orders, **transactions),
        "int_orders_enriched_in_cells": _with(_ENRICHED, **orders, **transactions),
        "dim_customers": _with(
            """
            select customer_id, customer_name as full_name, cast(null as varchar) as email,
                   'FR' as country, created_ts
            from stg_customers
            """,
            raw_transactions=_RAW_TRANSACTIONS,
            stg_customers=_CUSTOMERS.format(raw="raw_transactions"),
        ),
        "fct_orders_daily": daily,
        "fct_orders_daily_window": _with(
            "select order_date, customer_id, nb_orders, total_amount from daily "
            f"where order_date >= {today} - 7",
            **orders,
            daily=_DAILY,
        ),
        "fct_orders_daily_round_trip": daily,
        "fct_by_date_range": days,
        "guarded_daily": days,
        "fct_orders_daily_incremental": doubled,
        "fct_orders_daily_table": doubled,
        "fct_orders_daily_late": daily,
        "enterprise_orders_daily": daily,
        "append_load": _with(_STG_TRANSACTIONS, raw_transactions=_RAW_TRANSACTIONS),
        "copy_table": "select * from customer",
        "layered_run": _with(_GOLD.format(env="staging"), **clean),
        "tagged_run": daily,
        "assert_sample_not_null": _with(
            "select id, name, amount, ts from sample_curated where id is null or name is null",
            **dirty,
        ),
        "assert_orders_not_null": _with(
            """
            select cast(id as varchar) as order_id, name as order_name,
                   cast(amount as decimal(38, 9)) as order_amount,
                   event_ts as order_ts, 'raw_ext' as record_source
            from raw_orders where id is null
            """,
            raw_orders=_RAW_ORDERS,
        ),
        "assert_enterprise_keys": _with(
            "select * from daily where order_date is null or customer_id is null",
            **orders,
            daily=_DAILY,
        ),
        "int_orders_enriched_day": _with(
            f"select * from enriched where order_date = {start}",
            **orders,
            **transactions,
            enriched=_ENRICHED,
        ),
        "quality_checks": _with(
            """
            select check_name, cast(failing as bigint) as failing, failing = 0 as passed from (
                select 'sample_curated_not_empty' as check_name,
                       case when count(*) = 0 then 1 else 0 end as failing from sample_curated
                union all
                select 'sample_curated_id_not_null', count(*) from sample_curated
                where id is null
                union all
                select 'amount_by_name_gold_not_empty',
                       case when count(*) = 0 then 1 else 0 end from gold
                union all
                select 'amount_by_name_gold_name_not_null', count(*) from gold
                where name is null
                union all
                select 'negative_amounts', count(*) from sample_curated where amount < 0
                union all
                select 'sample_curated_not_empty',
                       case when count(*) = 0 then 1 else 0 end from sample_curated
                union all
                select 'amount_by_name_gold_not_empty',
                       case when count(*) = 0 then 1 else 0 end from gold
            )
            """,
            **dirty,
            gold=gold_dirty,
        ),
        "smoke_check": """
            select 'lineitem' as table_name, cast(11 as bigint) as n_columns,
                   count(*) as n_rows, count(*) >= 1 as passed
            from lineitem
        """,
    }
