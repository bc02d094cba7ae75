"""Totals at sf0.01 that Spark and DuckDB agreed on before any of this was written."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stratiform.plans import (
    amount_by_name_gold,
    dim_customers,
    fct_orders_daily,
    int_orders_enriched,
    sample_curated,
    stg_customers,
    stg_orders,
    stg_sales_transactions,
)
from stratiform.plans.adapters import raw_sample, raw_sample_dirty, table

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


def customer():
    return F.concat(F.lit("cust-"), (F.col("o_custkey") % 20).cast("string"))


@pytest.fixture(scope="module")
def orders(spark):
    joined = table(spark, SF, "lineitem").join(
        table(spark, SF, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    return stg_orders(
        joined.select(
            F.when(F.col("l_partkey") % 97 != 0, F.col("l_orderkey")).alias("id"),
            F.when(F.col("l_partkey") % 89 != 0, customer()).alias("name"),
            F.col("l_extendedprice").alias("amount"),
            F.col("o_orderdate").alias("event_ts"),
        )
    )


@pytest.fixture(scope="module")
def transactions(spark):
    return table(spark, SF, "orders").select(
        F.col("o_orderkey").alias("id"),
        customer().alias("name"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderdate").alias("event_ts"),
    )


def test_daily_fact(orders):
    assert orders.count() == 59_354
    daily = fct_orders_daily(orders)
    assert daily.agg(
        F.count(F.lit(1)),
        F.sum("nb_orders"),
        F.sum("total_amount"),
        F.count_if(F.col("customer_id").isNull()),
    ).first() == (13_262, 15_323, Decimal("3149876965.770000000"), 534)
    window = fct_orders_daily(orders, incremental=True, as_of=dt.date(2001, 8, 1))
    assert window.agg(F.count(F.lit(1)), F.sum("nb_orders"), F.sum("total_amount")).first() == (
        46,
        55,
        Decimal("12540388.000000000"),
    )


@pytest.mark.parametrize("hot_rows", [1_000_000, 2])
def test_enriched_orders(orders, transactions, hot_rows):
    joined = int_orders_enriched(
        orders, stg_sales_transactions(transactions), hot_rows=hot_rows
    )
    assert joined.agg(F.count(F.lit(1)), F.count("transaction_id")).first() == (77_088, 76_463)


def test_customers(transactions):
    assert dim_customers(stg_customers(transactions)).count() == 20


def test_gold_and_tolerant_casts(spark):
    gold = amount_by_name_gold(sample_curated(raw_sample(spark, SF)))
    assert gold.agg(F.count(F.lit(1)), F.sum("nb_rows"), F.sum("total_amount")).first() == (
        5,
        10_000,
        Decimal("496306.570000000"),
    )
    dirty = sample_curated(raw_sample_dirty(spark, SF))
    assert dirty.agg(*[F.count(c) for c in ("id", "name", "amount", "ts")]).first() == (
        9_800,
        9_859,
        9_833,
        9_857,
    )
    assert dirty.agg(F.sum("amount"), F.count_if(F.col("amount") < 0)).first() == (
        Decimal("472806.780000000"),
        161,
    )
