import pytest
from conftest import at
from pyspark.sql import functions as F

from stratiform.operators import Check, QualityError, assert_no_rows, enforce, run_checks
from stratiform.operators import checks
from stratiform.operators.smoke import (
    NOT_FOUND,
    OK,
    TOO_FEW_ROWS,
    UNREADABLE,
    smoke_check,
    smoke_check_source,
)
from stratiform.plans import quality_report, stg_orders
from stratiform.sources import RawSource
from stratiform.sources.readers import plan_text

CURATED = "id BIGINT, name STRING, amount DECIMAL(38,9), ts TIMESTAMP"


def report(df, *wanted):
    return {r.check_name: (r.failing, r.passed) for r in run_checks(df, wanted).collect()}


def test_checks_count_violations(spark):
    df = spark.sql("SELECT * FROM VALUES (1, -1.5), (NULL, 2.0), (3, NULL) t(id, amount)")
    assert report(
        df,
        Check.not_empty("t"),
        Check.no_nulls("t", "id"),
        Check.none("negative", F.col("amount") < 0, "negative amounts"),
        Check.none("large", F.col("amount") > 10, "large amounts"),
    ) == {
        "t_not_empty": (0, True),
        "t_id_not_null": (1, False),
        "negative": (1, False),
        "large": (0, True),
    }


def test_empty_table(spark):
    empty = spark.createDataFrame([], CURATED)
    assert report(empty, *checks.sample_checks()) == {
        "sample_curated_not_empty": (1, False),
        "sample_curated_id_not_null": (0, True),
    }


def test_all_checks_share_one_pass(spark, tmp_path):
    path = f"{tmp_path}/t"
    spark.sql("SELECT 1L id, 'a' name, 1.0 amount").write.parquet(path)
    df = spark.read.parquet(path)
    plan = plan_text(run_checks(df, checks.sample_checks()), "simple")
    assert plan.count("FileScan") == 1
    assert "ReadSchema: struct<id:bigint>" in plan


def test_enforce_names_every_failure(spark):
    df = spark.sql("SELECT CAST(NULL AS BIGINT) id, CAST(NULL AS STRING) name")
    wanted = [Check.no_nulls("t", "id"), Check.no_nulls("t", "name"), Check.not_empty("t")]
    with pytest.raises(QualityError, match="id contains NULLs.*name contains NULLs"):
        enforce(run_checks(df, wanted))
    enforce(run_checks(df, [Check.not_empty("t")]))


def test_cross_layer_report(spark):
    curated = spark.sql("SELECT 1L id, 'a' name, CAST(-1 AS DECIMAL(38,9)) amount")
    gold = spark.sql("SELECT 'a' name WHERE false")
    got = {r.check_name: r.passed for r in quality_report(curated, gold).collect()}
    assert got == {
        "sample_curated_not_empty": True,
        "negative_amounts": False,
        "amount_by_name_gold_not_empty": False,
    }


def test_assertions(spark, raw):
    good = raw((1, "a", 1.0, at("2024-01-01")))
    bad = raw((1, None, 1.0, at("2024-01-01")), (None, "a", 1.0, None), (2, "b", 1.0, None))
    assert_no_rows(checks.sample_null_rows(good), "sample")
    assert checks.sample_null_rows(bad).count() == 2
    with pytest.raises(QualityError, match="sample"):
        assert_no_rows(checks.sample_null_rows(bad), "sample")
    assert_no_rows(checks.order_null_rows(stg_orders(bad)), "orders")
    broken = stg_orders(bad).withColumn("order_id", F.lit(None).cast("string"))
    with pytest.raises(QualityError):
        assert_no_rows(checks.order_null_rows(broken), "orders")


def test_smoke_check(spark, namespace):
    name = f"{namespace}.some"
    assert smoke_check(spark, name).code == NOT_FOUND
    spark.range(3).write.saveAsTable(name)
    result = smoke_check(spark, name, min_rows=3, limit=2)
    assert (result.code, result.columns, result.rows, len(result.sample)) == (OK, 1, 3, 2)
    assert result.table_type == "MANAGED" and result.ok
    assert smoke_check(spark, name, min_rows=4).code == TOO_FEW_ROWS


def test_smoke_check_source(spark, tmp_path):
    good = f"{tmp_path}/good"
    spark.range(3).write.parquet(good)
    result = smoke_check_source(spark, RawSource("good", (f"{good}/*.parquet",)), limit=2)
    assert (result.code, result.columns, len(result.sample)) == (OK, 1, 2)
    missing = RawSource("missing", (f"{tmp_path}/nowhere/*.parquet",))
    assert smoke_check_source(spark, missing).code == NOT_FOUND
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.parquet").write_text("this is no such file")
    bad = RawSource("bad", (f"{tmp_path}/bad/*.parquet",))
    assert smoke_check_source(spark, bad).code == UNREADABLE
