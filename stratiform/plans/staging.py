"""Staging models: raw rows (id, name, amount, event_ts) become typed columns.

Each is a projection over the raw scan, so column pruning and the NULL filters reach
the files. ``at`` replaces the wall clock in tests.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiform.functions import INT64, NUMERIC, STRING, TIMESTAMP, strict, utc_date
from stratiform.operators.lineage import now, with_lineage


def src_raw_orders(raw: DataFrame, *, at: dt.datetime | None = None) -> DataFrame:
    """Raw orders under business names; nothing is filtered."""
    typed = raw.select(
        strict(raw, "id", STRING).alias("order_id"),
        strict(raw, "name", STRING).alias("order_name"),
        strict(raw, "amount", NUMERIC).alias("order_amount"),
        strict(raw, "event_ts", TIMESTAMP).alias("order_ts"),
    )
    return with_lineage(typed, stamp="load_ts", at=at, record_source="raw_ext")


def stg_orders(raw: DataFrame, *, at: dt.datetime | None = None) -> DataFrame:
    """Orders with an id. A missing name stays, as a NULL customer."""
    timestamp = strict(raw, "event_ts", TIMESTAMP)
    return raw.where(F.col("id").isNotNull()).select(
        strict(raw, "id", STRING).alias("order_id"),
        strict(raw, "name", STRING).alias("customer_id"),
        timestamp.alias("order_timestamp"),
        utc_date(timestamp).alias("order_date"),
        strict(raw, "amount", NUMERIC).alias("amount"),
        now(at).alias("load_ts"),
    )


def stg_sales_transactions(raw: DataFrame, *, at: dt.datetime | None = None) -> DataFrame:
    """Transactions with an id: one raw name is both customer and product, one raw
    amount both unit price and amount, for a quantity of one."""
    timestamp = strict(raw, "event_ts", TIMESTAMP)
    name = strict(raw, "name", STRING)
    amount = strict(raw, "amount", NUMERIC)
    return raw.where(F.col("id").isNotNull()).select(
        strict(raw, "id", STRING).alias("transaction_id"),
        timestamp.alias("transaction_ts"),
        utc_date(timestamp).alias("order_date"),
        name.alias("customer_id"),
        name.alias("product_id"),
        F.lit(1).cast(INT64).alias("qty"),
        amount.alias("unit_price"),
        amount.alias("amount"),
        F.lit("EUR").alias("currency"),
        F.lit("FR").alias("country"),
        now(at).alias("ingestion_ts"),
        now(at).alias("load_ts"),
    )


def stg_customers(raw: DataFrame, *, at: dt.datetime | None = None) -> DataFrame:
    """One row per named customer with the first time it was seen.

    As a query this is a minimum over a window per name with DISTINCT on top. All
    columns follow from the name, so that equals one grouped minimum, which combines
    before the shuffle and never brings the rows of a frequent name into one task.
    """
    name = strict(raw, "name", STRING)
    return (
        raw.where(F.col("name").isNotNull())
        .select(name.alias("customer_id"), strict(raw, "event_ts", TIMESTAMP).alias("_seen"))
        .groupBy("customer_id")
        .agg(F.min("_seen").alias("created_ts"))
        .select(
            "customer_id",
            F.col("customer_id").alias("customer_name"),
            "created_ts",
            now(at).alias("load_ts"),
        )
    )


def stg_sample(raw: DataFrame, *, at: dt.datetime | None = None) -> DataFrame:
    """Strict typed copy: a value that does not fit fails the load."""
    typed = raw.select(
        strict(raw, "id", INT64).alias("id"),
        strict(raw, "name", STRING).alias("name"),
        strict(raw, "amount", NUMERIC).alias("amount"),
        strict(raw, "event_ts", TIMESTAMP).alias("event_ts"),
    )
    return with_lineage(typed, stamp="ingested_at", at=at, record_source="raw_ext")
