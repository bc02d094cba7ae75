import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stratiform.functions import INT64, NUMERIC, STRING, TIMESTAMP, safe, strict, utc_date


def values(df, column):
    return [r[0] for r in df.select(column.alias("v")).collect()]


def column_of(spark, kind, *items):
    return spark.createDataFrame([(i,) for i in items], f"v {kind}").coalesce(1)


@pytest.mark.parametrize("cast", [strict, safe])
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_values_that_fit(spark, cast, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        whole = column_of(spark, "double", 2.5, -2.5, 2.4, None)
        assert values(whole, cast(whole, "v", INT64)) == [3, -3, 2, None]
        number = column_of(spark, "double", 0.1234567895, -0.1234567895, None)
        assert values(number, cast(number, "v", NUMERIC)) == [
            Decimal("0.123456790"),
            Decimal("-0.123456790"),
            None,
        ]
        text = column_of(spark, "string", "10.5", "-3", None)
        assert values(text, cast(text, "v", NUMERIC)) == [Decimal("10.5"), Decimal(-3), None]
        key = column_of(spark, "bigint", 7, None)
        assert values(key, cast(key, "v", STRING)) == ["7", None]
        assert values(key, cast(key, "v", NUMERIC)) == [Decimal(7), None]
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


@pytest.mark.parametrize(
    "kind, bad, target",
    [
        ("string", "x", INT64),
        ("string", "10.5", INT64),
        ("string", "x", NUMERIC),
        ("string", "2024-13-01 00:00:00", TIMESTAMP),
        ("string", "2024", TIMESTAMP),
        ("string", "12:30:00", TIMESTAMP),
        ("double", float("nan"), NUMERIC),
        ("double", float("inf"), NUMERIC),
        ("double", 1e300, NUMERIC),
        ("double", float("nan"), INT64),
        ("double", 1e19, INT64),
    ],
)
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_values_that_do_not_fit(spark, kind, bad, target, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = column_of(spark, kind, bad)
        assert values(df, safe(df, "v", target)) == [None]
        with pytest.raises(Exception, match="cannot cast v to"):
            values(df, strict(df, "v", target))
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_types(spark):
    df = column_of(spark, "double", 1.0)
    out = df.select(*[strict(df, "v", t).alias(t) for t in (STRING, INT64, NUMERIC)])
    assert [t for _, t in out.dtypes] == ["string", "bigint", "decimal(38,9)"]
    with pytest.raises(ValueError):
        strict(df, "v", "float")


def test_date_is_the_utc_date(spark):
    df = spark.sql("SELECT timestamp'2024-01-31 23:59:59.999999' v")
    assert values(df, utc_date(strict(df, "v", TIMESTAMP))) == [dt.date(2024, 1, 31)]
    east = spark.sql("SELECT timestamp'2024-02-01 00:30:00+02:00' v")
    assert values(east, utc_date(F.col("v"))) == [dt.date(2024, 1, 31)]


def test_ntz_becomes_an_instant_in_utc(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-31 23:00:00' v")
    out = df.select(strict(df, "v", TIMESTAMP).alias("v"))
    assert out.dtypes == [("v", "timestamp")]
    assert out.select(F.unix_timestamp("v")).first()[0] == 1706742000


@pytest.mark.parametrize("cast", [strict, safe])
@pytest.mark.parametrize(
    "source, target",
    [
        ("bigint", TIMESTAMP),
        ("double", TIMESTAMP),
        ("timestamp", INT64),
        ("date", INT64),
        ("timestamp", NUMERIC),
    ],
)
def test_numbers_and_points_in_time_do_not_mix(spark, cast, source, target):
    with pytest.raises(TypeError, match="no cast"):
        cast(spark.createDataFrame([], f"x {source}"), "x", target)
