"""Data-quality checks: any number of them in one pass over a table."""

from __future__ import annotations

import operator
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class QualityError(RuntimeError):
    """At least one check failed; the message names them all."""


@dataclass(frozen=True)
class Check:
    """One rule. ``failing`` aggregates a table to the number of its violations."""

    name: str
    failing: Column
    message: str

    @staticmethod
    def not_empty(table: str) -> Check:
        empty = (F.count(F.lit(1)) == 0).cast("bigint")
        return Check(f"{table}_not_empty", empty, f"{table} is empty")

    @staticmethod
    def no_nulls(table: str, column: str) -> Check:
        nulls = F.count_if(F.col(column).isNull())
        return Check(f"{table}_{column}_not_null", nulls, f"{table}: {column} contains NULLs")

    @staticmethod
    def none(name: str, bad: Column, message: str) -> Check:
        """No row may satisfy ``bad``; rows where it is NULL do not count."""
        return Check(name, F.count_if(bad), message)


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row per check: its name, the number of violations, whether it passed.

    All checks of a table share a single aggregation, so the table is read once and
    only the columns the checks use.
    """
    counts = df.agg(*[c.failing.alias(f"f{i}") for i, c in enumerate(checks)])
    rows = F.array(
        *[
            F.struct(
                F.lit(c.name).alias("check_name"),
                F.col(f"f{i}").cast("bigint").alias("failing"),
                F.lit(c.message).alias("message"),
            )
            for i, c in enumerate(checks)
        ]
    )
    return counts.select(F.inline(rows)).select(
        "check_name", "failing", (F.col("failing") == 0).alias("passed"), "message"
    )


def observed(df: DataFrame, checks: Sequence[Check]) -> tuple[DataFrame, Observation | None]:
    """The frame, with the checks counted by whatever next writes it, and where they appear.

    Put it after the last shuffle of what is written: a shuffle may read its input twice.
    """
    if not checks:
        return df, None
    counted = Observation()
    return df.observe(counted, *[c.failing.alias(f"f{i}") for i, c in enumerate(checks)]), counted


def failed(counted: Observation | None, checks: Sequence[Check]) -> list[str]:
    """Messages of the checks that did not hold while the rows were written."""
    if counted is None:
        return []
    found = counted.get
    return [f"{c.message} ({found[f'f{i}']})" for i, c in enumerate(checks) if found[f"f{i}"]]


def enforce(report: DataFrame) -> DataFrame:
    """Raise :class:`QualityError` if a check of the report failed.

    Only failed checks come to the driver, at most one row per check.
    """
    failed = report.where(~F.col("passed")).collect()
    if failed:
        raise QualityError("; ".join(f"{r['message']} ({r['failing']})" for r in failed))
    return report


def assert_no_rows(offending: DataFrame, name: str) -> None:
    """An assertion holds when its query finds nothing; one row is enough to fail it."""
    if not offending.isEmpty():
        raise QualityError(f"{name}: offending rows found")


def sample_null_rows(sample: DataFrame) -> DataFrame:
    """Offending rows: a sample without id or without name."""
    return sample.where(F.col("id").isNull() | F.col("name").isNull())


def order_null_rows(orders: DataFrame) -> DataFrame:
    """Offending rows: an order without id. Staging drops these, so ask before it."""
    return orders.where(F.col("order_id").isNull())


def enterprise_null_rows(
    enterprise: DataFrame, keys: Sequence[str] = ("order_date", "customer_id")
) -> DataFrame:
    """Offending rows: a published daily row without one of its key columns."""
    return enterprise.where(reduce(operator.or_, [F.col(key).isNull() for key in keys]))


def sample_checks() -> list[Check]:
    return [
        Check.not_empty("sample_curated"),
        Check.no_nulls("sample_curated", "id"),
    ]


def gold_checks() -> list[Check]:
    return [
        Check.not_empty("amount_by_name_gold"),
        Check.no_nulls("amount_by_name_gold", "name"),
    ]


def cross_layer_checks() -> dict[str, list[Check]]:
    """The checks that run after all layers, by table."""
    return {
        "sample_curated": [
            Check.not_empty("sample_curated"),
            Check.none("negative_amounts", F.col("amount") < 0, "negative amounts found"),
        ],
        "amount_by_name_gold": [Check.not_empty("amount_by_name_gold")],
    }
