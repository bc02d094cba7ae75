"""Every registered query against its SQL, with equal columns, types and rows."""

import os
import re

import oracle
import pytest

import __spark_entry__ as entry

SF = f"{oracle.TESTDATA}/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")

ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    columns, rows = oracle.spark_bag(df)
    if name not in ORACLES:
        assert rows
        return
    assert (columns, rows) == oracle.duck_bag(duck, ORACLES[name])
    assert oracle.spark_types(df) == oracle.duck_types(duck, ORACLES[name])


def test_only_the_preview_has_no_sql():
    without = set(entry.queries()) - set(ORACLES)
    # Training-data operators have tests of their own.
    assert {n for n in without if not re.match(r"op\d+_|pipeline$", n)} == {"preview"}
    assert set(ORACLES) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["order_date", "customer_id", "nb_orders", "total_amount"]
    assert not df.isEmpty()
