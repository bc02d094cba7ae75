import datetime as dt
import random
from collections import Counter
from decimal import Decimal

import pytest
from conftest import at
from pyspark.sql import functions as F

from stratiform.operators.joins import fanout_left_join, hot_keys
from stratiform.plans import (
    enterprise_orders_daily,
    fct_orders_daily,
    int_orders_enriched,
    stg_orders,
    stg_sales_transactions,
)

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


@pytest.fixture
def orders(raw):
    return stg_orders(
        raw(
            (1, "ann", 10.0, at("2024-01-01", "08:00:00")),
            (1, "ann", 5.0, at("2024-01-01", "09:00:00")),
            (1, "ann", 1.0, at("2024-01-02")),
            (2, "ann", 2.0, at("2024-01-01")),
            (3, None, 3.0, at("2024-01-01")),
            (4, "bob", 4.0, None),
            (5, "eve", -1.5, at("2024-01-09")),
            (None, "ann", 99.0, at("2024-01-01")),
        )
    )


def test_fct_orders_daily(orders):
    out = fct_orders_daily(orders)
    assert out.dtypes == [
        ("order_date", "date"),
        ("customer_id", "string"),
        ("nb_orders", "bigint"),
        ("total_amount", "decimal(38,9)"),
    ]
    assert {(r[0], r[1]): (r[2], r[3]) for r in out.collect()} == {
        (D1, "ann"): (2, Decimal(17)),
        (D2, "ann"): (1, Decimal(1)),
        (D1, None): (1, Decimal(3)),
        (None, "bob"): (1, Decimal(4)),
        (dt.date(2024, 1, 9), "eve"): (1, Decimal("-1.5")),
    }
    total = orders.agg(F.sum("amount")).first()[0]
    assert out.agg(F.sum("total_amount")).first()[0] == total


def test_incremental_window_is_seven_days_inclusive(orders):
    window = fct_orders_daily(orders, incremental=True, as_of=dt.date(2024, 1, 9))
    assert {r.order_date for r in window.collect()} == {D2, dt.date(2024, 1, 9)}
    assert fct_orders_daily(orders, incremental=True).count() == 0
    assert fct_orders_daily(orders, as_of=dt.date(2024, 1, 9)).count() == 5


def test_enterprise_is_a_projection(orders):
    daily = fct_orders_daily(orders).withColumn("extra", F.lit(1))
    assert enterprise_orders_daily(daily).columns == [
        "order_date",
        "customer_id",
        "nb_orders",
        "total_amount",
    ]


@pytest.mark.parametrize("hot_rows", [1_000_000, 1])
def test_int_orders_enriched(raw, orders, hot_rows):
    transactions = stg_sales_transactions(
        raw(
            (71, "ann", 1.0, at("2024-01-01", "01:00:00")),
            (72, "ann", 2.0, at("2024-01-01", "02:00:00")),
            (73, None, 3.0, at("2024-01-01")),
            (74, "eve", 4.0, at("2024-01-01")),
            (75, "bob", 5.0, None),
        )
    )
    out = int_orders_enriched(orders, transactions, hot_rows=hot_rows)
    assert out.columns == [
        "order_id",
        "customer_id",
        "order_date",
        "order_amount",
        "transaction_id",
        "transaction_amount",
        "enriched_ts",
    ]
    got = Counter((r.order_id, r.order_amount, r.transaction_id) for r in out.collect())
    expected = Counter(
        (o, Decimal(a), t) for o, a in (("1", 10), ("1", 5), ("2", 2)) for t in ("71", "72")
    )
    expected.update(
        [
            ("1", Decimal(1), None),
            ("3", Decimal(3), None),
            ("4", Decimal(4), None),
            ("5", Decimal("-1.5"), None),
        ]
    )
    assert got == expected


LEFT, RIGHT = "k INT, d INT, a INT", "k INT, d INT, b INT"


def brute_force(left, right):
    pairs = Counter()
    for k, d, a in left:
        found = [b for k2, d2, b in right if None not in (k, d) and (k, d) == (k2, d2)]
        pairs.update((k, d, a, b) for b in found or [None])
    return pairs


@pytest.mark.parametrize("seed", range(4))
def test_fanout_left_join_equals_brute_force(spark, seed):
    """A third of both sides on one key, a third of that exact copies, NULL keys."""
    rng = random.Random(seed)

    def side(n):
        out = []
        for _ in range(n):
            hot = rng.random() < 0.34
            k = 1 if hot else rng.choice([None, *range(8)])
            value = 0 if rng.random() < 0.34 else rng.randrange(50)
            out.append((k, 1 if hot else rng.choice([None, 1, 2]), value))
        return out

    left, right = side(60), side(120)
    got = fanout_left_join(
        spark.createDataFrame(left, LEFT),
        spark.createDataFrame(right, RIGHT),
        ["k", "d"],
        hot_rows=4,
        piece=3,
    )
    assert Counter((r.k, r.d, r.a, r.b) for r in got.collect()) == brute_force(left, right)


def test_fanout_left_join_with_empty_sides(spark):
    some = spark.createDataFrame([(1, 1, 1)] * 9, LEFT)
    none = spark.createDataFrame([], RIGHT)
    assert fanout_left_join(some, none, ["k", "d"], hot_rows=1).count() == 9
    right = spark.createDataFrame([(1, 1, 1)] * 9, RIGHT)
    assert fanout_left_join(none.withColumnRenamed("b", "a"), right, ["k", "d"]).count() == 0
    assert fanout_left_join(some, right, ["k", "d"], hot_rows=1, piece=2).count() == 81


def test_hot_key_rows_are_spread(spark):
    """The right rows of a hot key land in as many cells as it has shares of rows."""
    right = spark.range(1000).selectExpr("1 k", "1 d", "cast(id as int) b")
    [row] = hot_keys(right, ["k", "d"], hot_rows=100).collect()
    assert row["_cells"] == 10
    assert hot_keys(right, ["k", "d"], hot_rows=1000).count() == 0
