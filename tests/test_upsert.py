import datetime as dt
from decimal import Decimal

import pytest
from conftest import at
from pyspark.sql import functions as F

from stratiform.plans import fct_orders_daily, stg_orders
from stratiform.sinks import DuplicateKeys, append_table, manifests, upsert_partitions
from stratiform.sinks import upsert as module
from stratiform.storage import path_exists

FACT = "order_date DATE, customer_id STRING, nb_orders BIGINT, total_amount DECIMAL(38,9)"
KEYS = {"keys": ["order_date", "customer_id"], "partition_col": "order_date"}


def day(n):
    return dt.date(2024, 1, n)


@pytest.fixture(params=["path", "table"])
def target(request, tmp_path, namespace):
    return f"{tmp_path}/fct" if request.param == "path" else f"{namespace}.fct"


@pytest.fixture
def fact(spark):
    def make(*rows):
        typed = [(d, c, n, Decimal(a)) for d, c, n, a in rows]
        return spark.createDataFrame(typed, FACT)

    return make


def content(df):
    rows = df.select("order_date", "customer_id", "nb_orders", "total_amount").collect()
    assert len({(r[0], r[1]) for r in rows}) == len(rows)
    return {(r[0], r[1]): (r[2], int(r[3])) for r in rows}


BEFORE = (
    (day(1), "ann", 1, 10),
    (day(8), "ann", 1, 20),
    (day(8), "gone", 1, 30),
    (day(8), None, 1, 40),
    (None, "ann", 1, 50),
)
NEW = ((day(8), "ann", 2, 21), (day(8), None, 2, 41), (day(9), "bob", 1, 60))
AFTER = {
    (day(1), "ann"): (1, 10),  # before the window
    (day(8), "ann"): (2, 21),  # updated
    (day(8), "gone"): (1, 30),  # vanished from the new data, stays
    (day(8), None): (2, 41),  # NULL key updated, not added again
    (None, "ann"): (1, 50),  # partition that was not touched
    (day(9), "bob"): (1, 60),  # new partition
}


def test_upsert(spark, fact, target):
    upsert_partitions(fact(*BEFORE), target, **KEYS)
    assert content(upsert_partitions(fact(*NEW), target, **KEYS)) == AFTER
    assert content(upsert_partitions(fact(*NEW), target, **KEYS)) == AFTER


def test_null_partition(spark, fact, target):
    upsert_partitions(fact(*BEFORE), target, **KEYS)
    got = content(upsert_partitions(fact((None, "ann", 3, 51), (None, "x", 1, 1)), target, **KEYS))
    assert got[(None, "ann")] == (3, 51) and got[(None, "x")] == (1, 1) and len(got) == 6


def test_empty_window_changes_nothing(fact, target):
    before = content(upsert_partitions(fact(*BEFORE), target, **KEYS))
    assert content(upsert_partitions(fact(), target, **KEYS)) == before


def test_touched_partitions_and_those_between(fact, target):
    upsert_partitions(fact(*BEFORE), target, **KEYS)
    assert content(upsert_partitions(fact(*NEW), target, **KEYS)) == AFTER


def test_untouched_partitions_keep_their_files(spark, fact, target):
    def files(df):
        found = {}
        for path in df.inputFiles():
            found.setdefault(path.split("/")[-2], set()).add(path)
        return found

    before = files(upsert_partitions(fact(*BEFORE), target, **KEYS))
    after = files(upsert_partitions(fact(*NEW), target, **KEYS))
    for name, names in before.items():
        assert (after[name] == names) == (name != "order_date=2024-01-08")


def test_merged_rows_are_written_once(spark, fact, target, monkeypatch):
    upsert_partitions(fact(*BEFORE), target, **KEYS)
    written, real = [], module._write
    monkeypatch.setattr(
        module, "_write", lambda rows, *a: written.append(rows.count()) or real(rows, *a)
    )
    upsert_partitions(fact(*NEW), target, **KEYS)
    assert written == [4]  # the touched days only


@pytest.mark.parametrize("step", ["declare", "borrow", "point", "publish"])
def test_a_job_that_died_changed_nothing(spark, fact, target, monkeypatch, step):
    upsert_partitions(fact(*BEFORE), target, **KEYS)
    before = content(upsert_partitions(fact(), target, **KEYS))

    def die(*args, **kwargs):
        raise ConnectionError

    monkeypatch.setattr(manifests if step == "publish" else module.versions, step, die)
    if ("/" in target) == (step == "publish"):
        with pytest.raises(ConnectionError):
            upsert_partitions(fact(*NEW), target, **KEYS)
    monkeypatch.undo()
    if "/" in target:
        assert content(manifests.read(spark, target, fact().schema)) == before
    else:
        assert content(spark.newSession().table(target)) == before
    assert content(upsert_partitions(fact(*NEW), target, **KEYS)) == AFTER


def test_readers_that_have_begun_finish(spark, fact, target):
    begun = upsert_partitions(fact(*BEFORE), target, **KEYS)
    begun._jdf.queryExecution().executedPlan()
    upsert_partitions(fact(*NEW), target, **KEYS)
    assert len(content(begun)) == len(BEFORE)


def test_many_upserts_leave_two_versions_of_each_partition(spark, fact, target, tmp_path):
    days = {}
    for k in range(6):
        rows = [(day(n), "ann", k, k) for n in range(1, 8) if n % (k + 1) == 0]
        days.update({(r[0], r[1]): (r[2], r[3]) for r in rows})
        assert content(upsert_partitions(fact(*rows), target, **KEYS)) == days
    files = [str(p) for p in tmp_path.rglob("*.parquet")]
    for n in range(1, 8):
        assert 1 <= sum(f"order_date=2024-01-0{n}" in f for f in files) <= 2


def test_append_and_upsert_take_turns(spark, fact, namespace):
    target = f"{namespace}.fct"
    upsert_partitions(fact(*BEFORE), target, **KEYS)
    upsert_partitions(fact(*NEW), target, **KEYS)
    append_table(fact((day(1), "new", 1, 5), (day(20), "new", 1, 6)), target)
    got = content(upsert_partitions(fact((day(20), "ann", 1, 7)), target, **KEYS))
    assert got == AFTER | {
        (day(1), "new"): (1, 5), (day(20), "new"): (1, 6), (day(20), "ann"): (1, 7)
    }


def test_a_table_made_elsewhere(spark, fact, namespace):
    target = f"{namespace}.fct"
    fact(*BEFORE).write.partitionBy("order_date").saveAsTable(target)
    assert content(upsert_partitions(fact(*NEW), target, **KEYS)) == AFTER
    assert content(upsert_partitions(fact(*NEW), target, **KEYS)) == AFTER


def test_files_without_a_manifest_are_refused(fact, tmp_path):
    fact(*BEFORE).write.partitionBy("order_date").parquet(f"{tmp_path}/fct")
    with pytest.raises(ValueError, match="no manifest"):
        upsert_partitions(fact(*NEW), f"{tmp_path}/fct", **KEYS)


def test_duplicate_keys_are_refused(spark, fact, tmp_path):
    twice = fact((day(8), "ann", 1, 1), (day(8), "ann", 1, 2))
    target = f"{tmp_path}/fct"
    with pytest.raises(DuplicateKeys):
        upsert_partitions(twice, target, **KEYS)
    assert not path_exists(spark, target)
    upsert_partitions(fact(*BEFORE), target, **KEYS)
    with pytest.raises(DuplicateKeys):
        upsert_partitions(twice, target, **KEYS)
    assert len(content(manifests.read(spark, target, fact().schema))) == len(BEFORE)


def test_incremental_runs_catch_up_with_a_full_build(raw, target):
    """Late rows inside the window are picked up; the result equals a full refresh."""
    first = [
        (1, "ann", 1.0, at("2024-01-01")),
        (2, None, 2.0, at("2024-01-07")),
        (3, "ann", 3.0, at("2024-01-08")),
    ]
    late = [(4, "ann", 4.0, at("2024-01-03")), (5, None, 5.0, at("2024-01-07"))]
    late += [(6, "bob", 6.0, at("2024-01-10"))]
    upsert_partitions(fct_orders_daily(stg_orders(raw(*first))), target, **KEYS)
    everything = stg_orders(raw(*first, *late))
    window = fct_orders_daily(everything, incremental=True, as_of=day(10))
    got = content(upsert_partitions(window, target, **KEYS))
    assert got == content(fct_orders_daily(everything))


class Recorder:
    def __init__(self, spark):
        self.sparkSession, self.calls = spark, []

    def __getattr__(self, name):
        def call(*args):
            self.calls.append((name, *map(str, args)))
            return self

        return call


def test_v2_merge_compares_null_safe(spark, namespace):
    spark.sql(f"SELECT 1 a, 2 b").write.saveAsTable(f"{namespace}.t")
    new = Recorder(spark)
    module._merge(new, f"{namespace}.t", ["a", "b"])
    names = [c[0] for c in new.calls]
    assert names == [
        "alias",
        "mergeInto",
        "whenMatched",
        "updateAll",
        "whenNotMatched",
        "insertAll",
        "merge",
    ]
    assert new.calls[1][2].count("<=>") == 2 and "t.a" in new.calls[1][2]


@pytest.mark.parametrize("rows, nulls", [(NEW, False), (((None, "ann", 1, 1), NEW[0]), True)])
def test_v2_merge_names_the_range_of_partitions(fact, rows, nulls):
    text = str(module._range(fact(*rows), "order_date", F.col("t.order_date")))
    assert "2024-01-08" in text and ("IS NULL" in text.upper() or "isNull" in text) == nulls
