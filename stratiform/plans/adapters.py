"""The given test tables in the shape of the raw sources: id, name, amount, event_ts.

Orders have one row per line, so an order id repeats within a day and customer; some
ids and names are NULL. A customer stands for 75 neighbouring customer keys: several
orders of a day share one, and their number grows with the table, so the rows per day
and customer stay the same at every scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS_PER_CUSTOMER = 75


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _customer() -> F.Column:
    return F.concat(F.lit("cust-"), F.expr(f"o_custkey div {KEYS_PER_CUSTOMER}").cast("string"))


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.when(F.col("l_partkey") % 97 != 0, F.col("l_orderkey")).alias("id"),
        F.when(F.col("l_partkey") % 89 != 0, _customer()).alias("name"),
        F.col("l_extendedprice").alias("amount"),
        F.col("o_orderdate").alias("event_ts"),
    )


def raw_sales_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        _customer().alias("name"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderdate").alias("event_ts"),
    )


def raw_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        F.col("event_type").alias("name"),
        F.col("value").alias("amount"),
        F.col("ts").alias("event_ts"),
    )


def raw_sample_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sample as text, with values the typed columns cannot hold."""
    key = F.col("event_id")
    id_text, value_text = key.cast("string"), F.col("value").cast("string")
    return table(spark, sf_dir, "events").select(
        F.when(key % 50 == 0, F.concat(F.lit("bad-"), id_text)).otherwise(id_text).alias("id"),
        F.when(key % 71 != 0, F.col("event_type")).alias("name"),
        F.when(key % 60 == 0, F.lit("n/a"))
        .when(key % 61 == 0, F.concat(F.lit("-"), value_text))
        .otherwise(value_text)
        .alias("amount"),
        F.when(key % 70 == 0, F.lit("not a time"))
        .otherwise(F.col("ts").cast("string"))
        .alias("event_ts"),
    )
