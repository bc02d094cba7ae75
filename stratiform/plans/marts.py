"""Intermediate, mart and enterprise models."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratiform.functions import NUMERIC
from stratiform.operators.joins import fanout_left_join
from stratiform.operators.lineage import now

# Fixed value: how many days an incremental run of the daily fact looks back.
LOOK_BACK_DAYS = 7

FACT_KEYS = ("order_date", "customer_id")


def int_orders_enriched(
    orders: DataFrame,
    transactions: DataFrame,
    *,
    at: dt.datetime | None = None,
    hot_rows: int = 1_000_000,
    where: Column | None = None,
) -> DataFrame:
    """Each staged order with every transaction of its customer on its day.

    Orders without such a transaction stay, also those whose day or customer is
    NULL. Keys with more than ``hot_rows`` transactions are joined in cells.
    ``where`` is a condition on day and customer that both sides are to meet.
    """
    left = orders.select("order_id", *FACT_KEYS, F.col("amount").alias("order_amount"))
    right = transactions.select(
        *FACT_KEYS, "transaction_id", F.col("amount").alias("transaction_amount")
    )
    return fanout_left_join(left, right, FACT_KEYS, hot_rows=hot_rows, where=where).select(
        "order_id",
        "customer_id",
        "order_date",
        "order_amount",
        "transaction_id",
        "transaction_amount",
        now(at).alias("enriched_ts"),
    )


def dim_customers(customers: DataFrame) -> DataFrame:
    """One row per customer. On top of ``stg_customers`` it needs no further shuffle."""
    return customers.groupBy("customer_id").agg(
        F.any_value("customer_name").alias("full_name"),
        F.lit(None).cast("string").alias("email"),
        F.lit("FR").alias("country"),
        F.min("created_ts").alias("created_ts"),
    )


def look_back_start(as_of: dt.date | Column | None = None) -> Column:
    """First day of the incremental window that ends at ``as_of`` (default: today)."""
    if as_of is None:
        day = F.current_date()
    else:
        day = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return F.date_sub(day, LOOK_BACK_DAYS)


def fct_orders_daily(
    orders: DataFrame, *, incremental: bool = False, as_of: dt.date | Column | None = None
) -> DataFrame:
    """Orders and amount per day and customer; a NULL customer is a group of its own.

    The distinct count first groups by order as well, so even a day and customer
    with a third of all rows is spread over tasks by order id and only its
    distinct orders are shuffled. An incremental run aggregates the last days only;
    the date filter reaches the file scan through the casts.
    """
    if incremental:
        orders = orders.where(F.col("order_date") >= look_back_start(as_of))
    return orders.groupBy(*FACT_KEYS).agg(
        F.count_distinct("order_id").alias("nb_orders"),
        F.sum(F.col("amount").cast(NUMERIC)).alias("total_amount"),
    )


def enterprise_orders_daily(daily: DataFrame) -> DataFrame:
    """The published columns of the daily fact."""
    return daily.select(*FACT_KEYS, "nb_orders", "total_amount")
