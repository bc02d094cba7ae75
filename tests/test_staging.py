import datetime as dt
from decimal import Decimal

import pytest
from conftest import at

from stratiform.plans import (
    amount_by_name_gold,
    dim_customers,
    sample_curated,
    src_raw_orders,
    stg_customers,
    stg_orders,
    stg_sales_transactions,
    stg_sample,
)

NOW = at("2024-05-05")


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture
def orders(raw):
    return raw(
        (1, "ann", 10.5, at("2024-01-01", "23:59:59.999999")),
        (1, "ann", 0.12345678950001, at("2024-01-02", "00:00:00")),
        (None, "ann", 5.0, at("2023-12-31")),
        (3, None, 7.0, at("2024-01-01")),
        (4, "bob", None, None),
    )


def test_src_raw_orders_keeps_every_row(orders):
    out = src_raw_orders(orders, at=NOW)
    assert out.dtypes == [
        ("order_id", "string"),
        ("order_name", "string"),
        ("order_amount", "decimal(38,9)"),
        ("order_ts", "timestamp"),
        ("load_ts", "timestamp"),
        ("record_source", "string"),
    ]
    assert out.count() == 5
    assert {r.record_source for r in out.collect()} == {"raw_ext"}


def test_stg_orders(orders):
    out = stg_orders(orders, at=NOW)
    assert out.dtypes == [
        ("order_id", "string"),
        ("customer_id", "string"),
        ("order_timestamp", "timestamp"),
        ("order_date", "date"),
        ("amount", "decimal(38,9)"),
        ("load_ts", "timestamp"),
    ]
    got = rows(out.select("order_id", "customer_id", "order_date", "amount"))
    assert sorted(got, key=str) == sorted(
        [
            ("1", "ann", dt.date(2024, 1, 1), Decimal("10.5")),
            ("1", "ann", dt.date(2024, 1, 2), Decimal("0.123456790")),
            ("3", None, dt.date(2024, 1, 1), Decimal(7)),
            ("4", "bob", None, None),
        ],
        key=str,
    )


def test_stg_sales_transactions_fans_columns_out(orders):
    out = stg_sales_transactions(orders, at=NOW)
    assert out.columns == [
        "transaction_id",
        "transaction_ts",
        "order_date",
        "customer_id",
        "product_id",
        "qty",
        "unit_price",
        "amount",
        "currency",
        "country",
        "ingestion_ts",
        "load_ts",
    ]
    assert dict(out.dtypes)["qty"] == "bigint"
    for r in out.collect():
        assert r.customer_id == r.product_id and r.unit_price == r.amount
        assert (r.qty, r.currency, r.country) == (1, "EUR", "FR")


def test_stg_customers_first_seen(orders):
    out = stg_customers(orders, at=NOW)
    assert rows(out.drop("load_ts").orderBy("customer_id")) == [
        ("ann", "ann", dt.datetime(2023, 12, 31, 12)),
        ("bob", "bob", None),
    ]
    dim = dim_customers(out)
    assert dim.dtypes == [
        ("customer_id", "string"),
        ("full_name", "string"),
        ("email", "string"),
        ("country", "string"),
        ("created_ts", "timestamp"),
    ]
    assert rows(dim.orderBy("customer_id")) == [
        ("ann", "ann", None, "FR", dt.datetime(2023, 12, 31, 12)),
        ("bob", "bob", None, "FR", None),
    ]


def test_stg_customers_equals_window_with_distinct(spark, orders):
    orders.createOrReplaceTempView("orders_small")
    expected = spark.sql(
        """SELECT DISTINCT name customer_id, name customer_name,
                  min(event_ts) OVER (PARTITION BY name) created_ts
           FROM orders_small WHERE name IS NOT NULL"""
    )
    assert sorted(rows(stg_customers(orders).drop("load_ts"))) == sorted(rows(expected))


TEXT = "id STRING, name STRING, amount STRING, event_ts STRING"


@pytest.fixture
def texts(raw):
    return raw(
        ("1", "a", "10.5", "2024-01-02 03:04:05"),
        ("bad-2", "a", "1", "2024-01-01 00:00:00"),
        ("3", None, "n/a", "2024-13-01 00:00:00"),
        ("4", "b", "-2.25", None),
        schema=TEXT,
    )


def test_sample_curated_turns_bad_values_into_null(texts):
    out = sample_curated(texts, "staging", at=NOW)
    assert out.columns == ["id", "name", "amount", "ts", "ingestion_ts", "source_object", "env"]
    assert sorted(rows(out.select("id", "name", "amount", "ts")), key=str) == sorted(
        [
            (1, "a", Decimal("10.5"), dt.datetime(2024, 1, 2, 3, 4, 5)),
            (None, "a", Decimal(1), dt.datetime(2024, 1, 1)),
            (3, None, None, None),
            (4, "b", Decimal("-2.25"), None),
        ],
        key=str,
    )
    assert {(r.source_object, r.env) for r in out.collect()} == {("ext_sample_parquet", "staging")}


def test_gold(texts):
    out = amount_by_name_gold(sample_curated(texts), "dev", at=NOW)
    assert out.columns == [
        "name",
        "nb_rows",
        "total_amount",
        "first_ts",
        "last_ts",
        "built_ts",
        "env",
    ]
    got = {r.name: (r.nb_rows, r.total_amount, r.first_ts, r.last_ts) for r in out.collect()}
    assert got == {
        "a": (2, Decimal("11.5"), dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2, 3, 4, 5)),
        None: (1, None, None, None),
        "b": (1, Decimal("-2.25"), None, None),
    }


def test_stg_sample_is_strict(raw, texts):
    good = raw((1, "a", 1.5, at("2024-01-01")))
    out = stg_sample(good, at=NOW)
    assert out.columns == ["id", "name", "amount", "event_ts", "ingested_at", "record_source"]
    assert rows(out)[0][:3] == (1, "a", Decimal("1.5"))
    with pytest.raises(Exception, match="cannot cast"):
        stg_sample(texts).collect()
