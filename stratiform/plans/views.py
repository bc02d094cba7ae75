"""View models as SQL text over catalog names, so that they outlive the session that made them.

Each text says what the function of the same name in ``staging`` and ``marts`` computes; the
casts are the same text in both. A view is evaluated on each read, by any session that shares
the catalog. The join is a plain one here: which keys are hot is known only when it runs, so
that is left to adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from stratiform.config import EnvConfig
from stratiform.functions import INT64, NUMERIC, STRING, TIMESTAMP
from stratiform.functions.casts import strict_sql
from stratiform.sinks import ensure_namespace
from stratiform.sinks.versions import text


def _select(columns: dict[str, str], relation: str, rest: str = "") -> str:
    listed = ", ".join(f"{expression} AS {name}" for name, expression in columns.items())
    return f"SELECT {listed} FROM {relation} {rest}".rstrip()


def src_raw_orders(raw: T.StructType, relation: str) -> str:
    columns = {
        "order_id": strict_sql(raw, "id", STRING),
        "order_name": strict_sql(raw, "name", STRING),
        "order_amount": strict_sql(raw, "amount", NUMERIC),
        "order_ts": strict_sql(raw, "event_ts", TIMESTAMP),
        "load_ts": "current_timestamp()",
        "record_source": "'raw_ext'",
    }
    return _select(columns, relation)


def stg_orders(raw: T.StructType, relation: str) -> str:
    timestamp = strict_sql(raw, "event_ts", TIMESTAMP)
    columns = {
        "order_id": strict_sql(raw, "id", STRING),
        "customer_id": strict_sql(raw, "name", STRING),
        "order_timestamp": timestamp,
        "order_date": f"to_date({timestamp})",
        "amount": strict_sql(raw, "amount", NUMERIC),
        "load_ts": "current_timestamp()",
    }
    return _select(columns, relation, "WHERE id IS NOT NULL")


def stg_sales_transactions(raw: T.StructType, relation: str) -> str:
    timestamp = strict_sql(raw, "event_ts", TIMESTAMP)
    name, amount = strict_sql(raw, "name", STRING), strict_sql(raw, "amount", NUMERIC)
    columns = {
        "transaction_id": strict_sql(raw, "id", STRING),
        "transaction_ts": timestamp,
        "order_date": f"to_date({timestamp})",
        "customer_id": name,
        "product_id": name,
        "qty": f"CAST(1 AS {INT64})",
        "unit_price": amount,
        "amount": amount,
        "currency": "'EUR'",
        "country": "'FR'",
        "ingestion_ts": "current_timestamp()",
        "load_ts": "current_timestamp()",
    }
    return _select(columns, relation, "WHERE id IS NOT NULL")


def stg_customers(raw: T.StructType, relation: str) -> str:
    name = strict_sql(raw, "name", STRING)
    columns = {
        "customer_id": name,
        "customer_name": name,
        "created_ts": f"min({strict_sql(raw, 'event_ts', TIMESTAMP)})",
        "load_ts": "current_timestamp()",
    }
    return _select(columns, relation, f"WHERE name IS NOT NULL GROUP BY {name}")


def int_orders_enriched(orders: str, transactions: str) -> str:
    columns = {
        "order_id": "o.order_id",
        "customer_id": "o.customer_id",
        "order_date": "o.order_date",
        "order_amount": "o.amount",
        "transaction_id": "t.transaction_id",
        "transaction_amount": "t.amount",
        "enriched_ts": "current_timestamp()",
    }
    on = "o.order_date = t.order_date AND o.customer_id = t.customer_id"
    return _select(columns, f"{orders} o LEFT JOIN {transactions} t ON {on}")


def curated(cfg: EnvConfig, name: str) -> str:
    if cfg.catalog:
        return f"SELECT * FROM {cfg.table('curated_iceberg', name)}"
    return f"SELECT * FROM parquet.`{cfg.curated_root.rstrip('/')}/{name}`"


def one_row() -> str:
    return "SELECT 1 AS one"


def env_check(cfg: EnvConfig) -> str:
    return (
        f"SELECT {text(cfg.env)} AS env, {text(cfg.namespace('raw_ext'))} AS raw_ext_dataset, "
        f"{text(cfg.namespace('analytics'))} AS analytics_dataset"
    )


def view_name(cfg: EnvConfig, layer: str, name: str) -> str:
    """Views live in the session catalog, beside the raw tables, whatever ``cfg.catalog``."""
    return f"{cfg.namespace(layer)}.{name}"


def create_view(
    spark: SparkSession, name: str, body: str, properties: dict[str, str] | None = None
) -> str:
    """Create the view or replace its text, in one statement."""
    ensure_namespace(spark, name.rsplit(".", 1)[0])
    marked = ", ".join(f"{text(k)} = {text(v)}" for k, v in (properties or {}).items())
    listed = f" TBLPROPERTIES ({marked})" if marked else ""
    spark.sql(f"CREATE OR REPLACE VIEW {name}{listed} AS {body}")
    return name

