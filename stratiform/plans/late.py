"""The daily fact from files that came since, however old their rows are.

A look-back of some days misses what lands later than that. Here the files that no run has
taken in yet are read for their days, and exactly these days are computed anew, from all raw
rows of them. That equals a full build as long as raw files are only added; nothing is ever
removed from the fact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratiform.plans import marts, staging
from stratiform.sinks import staged, upsert_partitions
from stratiform.sources import ledger
from stratiform.sources.registry import RawSource

KEYS = {"keys": marts.FACT_KEYS, "partition_col": "order_date", "check_unique": False}


def touched_days(new_orders: DataFrame) -> DataFrame:
    """The days of some staged orders, the missing day included."""
    return new_orders.select("order_date").distinct()


def orders_of_days(orders: DataFrame, days: DataFrame) -> DataFrame:
    """All orders of the given days.

    The range of the days, one row on the driver, reaches the file scan; the semi-join leaves
    out the days in between.
    """
    least, most, missing = days.agg(
        F.min("order_date"), F.max("order_date"), F.count_if(F.col("order_date").isNull())
    ).first()
    day = F.col("order_date")
    within: Column = day.between(least, most) if least is not None else F.lit(False)
    if missing:
        within = within | day.isNull()
    wanted = days.select(day.alias("_day"))
    return orders.where(within).join(wanted, day.eqNullSafe(F.col("_day")), "left_semi")


def load_new_files(
    source: RawSource, orders: DataFrame, fact: str, files_seen: str, **layout
) -> DataFrame:
    """Bring ``fact`` up to date with the files of ``source`` and note them in ``files_seen``.

    ``orders`` are the staged orders of the whole source. Without a fact all days are built.
    Files that land during the run may be taken in already; the next run does their days again.
    """
    spark = orders.sparkSession
    files = ledger.unloaded(spark, ledger.listed(spark, source), files_seen)
    with staged(files, "new-files") as (new, _):
        if not spark.catalog.tableExists(fact):
            result = upsert_partitions(marts.fct_orders_daily(orders), fact, **KEYS, **layout)
        else:
            raw = ledger.read_files(spark, source, new)
            if raw is None:
                return spark.table(fact)
            with staged(touched_days(staging.stg_orders(raw)), "touched-days") as (days, _):
                changed = marts.fct_orders_daily(orders_of_days(orders, days))
                result = upsert_partitions(changed, fact, **KEYS, **layout)
        ledger.record(new, files_seen)
    return result
