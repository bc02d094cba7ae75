import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from stratiform.session import prepare  # noqa: E402

RAW = "id BIGINT, name STRING, amount DOUBLE, event_ts TIMESTAMP"
UTC = dt.timezone.utc


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", str(root / "warehouse"))
        .config("spark.checkpoint.dir", str(root / "shared"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield prepare(session)
    session.stop()


@pytest.fixture
def raw(spark):
    def make(*rows, schema=RAW):
        return spark.createDataFrame(list(rows), schema)

    return make


@pytest.fixture
def namespace(spark, tmp_path):
    """A namespace of its own, with its files below the test's folder."""
    name = "ns_" + tmp_path.name.lower().replace("-", "_")
    spark.sql(f"CREATE NAMESPACE {name} LOCATION '{tmp_path}/{name}'")
    yield name
    spark.sql(f"DROP NAMESPACE {name} CASCADE")


def at(day: str, time: str = "12:00:00") -> dt.datetime:
    return dt.datetime.fromisoformat(f"{day}T{time}").replace(tzinfo=UTC)
