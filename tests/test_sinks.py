import datetime as dt
import glob
import threading

import pytest
from pyspark.sql import functions as F

from stratiform.operators import Check, QualityError
from stratiform.sinks import (
    append_table,
    arrange,
    ensure_namespace,
    publish_table,
    publish_view,
    set_guard,
    staged,
    verify_readable,
    write_partitioned,
    write_table,
    write_v2,
)
from stratiform.sinks import upsert_partitions
from stratiform.sources import PartitionFilterRequired, read_partitioned, read_table
from stratiform.sources.readers import plan_text
from stratiform.storage import is_v2, path_exists

DAYS = "SELECT date_add(date'2024-01-01', cast(id % 4 as int)) d, id, id % 10 k FROM range(400)"


def bag(df):
    return sorted(tuple(r) for r in df.select(*sorted(df.columns)).collect())


def test_view_is_evaluated_on_read(spark, tmp_path):
    path = f"{tmp_path}/t"
    spark.range(2).write.parquet(path)
    publish_view(spark.read.parquet(path), "numbers_view")
    assert spark.table("numbers_view").count() == 2


def test_full_refresh_replaces_rows_and_schema(spark, namespace):
    name = f"{namespace}.t"
    publish_table(spark.range(5), name, comment="it's first", properties={"layer": "gold"})
    assert spark.table(name).count() == 5
    assert spark.catalog.getTable(name).description == "it's first"
    stored = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    assert stored["layer"] == "gold"
    out = publish_table(spark.sql("SELECT 'x' a, 1.5 b"), name)
    assert bag(out) == bag(spark.sql("SELECT 'x' a, 1.5 b"))
    assert bag(spark.table(name)) == bag(out)


def folders(spark, namespace):
    root = spark.catalog.getDatabase(namespace).locationUri.removeprefix("file:")
    return sorted(path.rsplit("/", 1)[-1] for path in glob.glob(f"{root}/*__*"))


def listed(spark, namespace):
    return [t.name for t in spark.catalog.listTables(namespace) if not t.isTemporary]


def published(spark, namespace):
    return [name for name in listed(spark, namespace) if "__" not in name]


def test_readers_that_have_begun_finish_on_the_version_before(spark, namespace):
    name = f"{namespace}.t"
    publish_table(spark.range(5), name)
    begun = spark.table(name)
    begun._jdf.queryExecution().executedPlan()
    publish_table(spark.range(6), name)
    assert begun.count() == 5 and spark.table(name).count() == 6
    publish_table(spark.range(7), name)
    assert len(folders(spark, namespace)) == 2 and spark.table(name).count() == 7
    assert folders(spark, namespace) == sorted(set(listed(spark, namespace)) - {"t"})


def test_a_reader_in_a_loop_never_misses_the_table(spark, namespace):
    """Another session reads all the time; partitions, columns and rows change under it."""
    name, seen, done = f"{namespace}.t", [], threading.Event()
    publish_table(spark.sql(DAYS), name, partition_by=["d"])
    other = spark.newSession()

    def read():
        while not done.is_set():
            try:
                seen.append(other.table(name).count())
            except Exception as err:  # noqa: BLE001
                seen.append(err)

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for k in range(1, 7):
            layout = {"partition_by": ["d"]} if k % 2 else {"cluster_by": ["k"]}
            publish_table(spark.sql(DAYS).where(f"k < {k}").withColumn(f"c{k}", F.lit(k)), name, **layout)
    finally:
        done.set()
        reader.join()
    assert len(seen) > 6 and set(seen) <= {400, *(40 * k for k in range(1, 7))}


def test_a_table_made_elsewhere_can_be_published_over(spark, namespace):
    name = f"{namespace}.t"
    spark.sql(DAYS).write.partitionBy("d").saveAsTable(name)
    append_table(spark.sql("SELECT 7 k, date'2030-01-01' d, 1000L id"), name)
    publish_table(spark.range(5), name)
    assert spark.table(name).count() == 5 and published(spark, namespace) == ["t"]


def test_failed_audit_leaves_the_published_table_alone(spark, namespace):
    name = f"{namespace}.t"
    publish_table(spark.range(5), name)
    bad = spark.sql("SELECT CAST(NULL AS BIGINT) id")
    with pytest.raises(QualityError, match="not published"):
        publish_table(bad, name, checks=[Check.no_nulls("t", "id")])
    assert spark.table(name).count() == 5
    with pytest.raises(QualityError):
        publish_table(bad, f"{namespace}.other", checks=[Check.no_nulls("t", "id")])
    assert not spark.catalog.tableExists(f"{namespace}.other")


@pytest.mark.parametrize("layout", [{}, {"partition_by": ["d"]}])
def test_a_publication_can_break_at_each_statement(spark, namespace, monkeypatch, layout):
    """At once, and without a handler, every session finds the old rows or the new ones. What
    the break left behind goes with the next publication."""
    name = f"{namespace}.t"
    old, new = spark.sql(DAYS), spark.sql(DAYS).where("k < 5")
    publish_table(old, name, **layout)
    real, seen, at = type(spark).sql, 0, 0
    while True:

        def statement(self, text, *args, **kwargs):
            nonlocal seen
            if text.split()[0] in ("DROP", "ALTER", "CREATE"):
                seen += 1
                if seen > at:
                    raise ConnectionError(text)
            return real(self, text, *args, **kwargs)

        seen = 0
        monkeypatch.setattr(type(spark), "sql", statement)
        try:
            publish_table(new, name, **layout)
            break
        except ConnectionError:
            pass
        finally:
            monkeypatch.undo()
        for session in (spark, spark.newSession()):
            assert session.table(name).count() in (400, 200)
        at += 1
    assert at >= 2 and spark.table(name).count() == 200
    append_table(old, name)
    assert spark.table(name).count() == 600 and published(spark, namespace) == ["t"]
    assert len(folders(spark, namespace)) == 2 == len(listed(spark, namespace)) - 1


def test_checks_are_counted_by_the_write(spark, namespace, tmp_path, monkeypatch):
    """One query writes and counts; nothing reads the files again."""
    spark.sql(DAYS).write.parquet(f"{tmp_path}/raw")
    rules = [Check.not_empty("t"), Check.none("low", F.col("k") < 3, "low k")]
    for layout in ({}, {"partition_by": ["d"]}, {"cluster_by": ["id"]}):
        with pytest.raises(QualityError, match=r"low k \(120\)"):
            publish_table(spark.read.parquet(f"{tmp_path}/raw"), f"{namespace}.t", checks=rules, **layout)
        assert not spark.catalog.tableExists(f"{namespace}.t")
    empty = spark.sql(DAYS).where("false")
    with pytest.raises(QualityError, match="t is empty"):
        publish_table(empty, f"{namespace}.t", checks=rules)
    with pytest.raises(QualityError, match="t is empty"):
        publish_table(spark.read.parquet(f"{tmp_path}/raw").where("id < 0"), f"{namespace}.t", checks=rules)
    actions = []
    monkeypatch.setattr("stratiform.sinks.tables.run_checks", lambda *a: actions.append(a))
    high = spark.read.parquet(f"{tmp_path}/raw").where("k >= 3")
    assert publish_table(high, f"{namespace}.t", checks=rules).count() == 280 and not actions


def test_the_guard_stays_with_the_table(spark, namespace):
    name, days = f"{namespace}.days", spark.sql(DAYS)
    publish_table(days, name, partition_by=["d"], require_partition_filter=True)
    spark.sql(f"CREATE VIEW {namespace}.of_days AS SELECT id, d day FROM {name}")
    fresh = spark.newSession()
    for source in (name, f"{namespace}.of_days"):
        with pytest.raises(PartitionFilterRequired):
            read_partitioned(fresh, source, require_filter=None)
        with pytest.raises(PartitionFilterRequired):
            read_table(fresh, source)
    joined = fresh.sql(f"SELECT a.id FROM {name} a JOIN {name} b ON a.id = b.id WHERE a.k = 1")
    with pytest.raises(PartitionFilterRequired):
        read_partitioned(fresh, joined, require_filter=None)
    one = read_table(fresh, f"{namespace}.of_days", F.col("day") == dt.date(2024, 1, 2), rows=3)
    assert one.frame.count() == 100 and len(one.sample) == 3
    assert one.schema == {"id": "bigint", "day": "date"}
    # A refresh keeps the guard, and so does an upsert.
    publish_table(days.where("k < 5"), name, partition_by=["d"])
    upsert_partitions(days.where("k = 0"), name, keys=["d", "id"], partition_col="d")
    with pytest.raises(PartitionFilterRequired):
        read_partitioned(fresh, name, require_filter=None)
    set_guard(spark, name, False)
    assert read_partitioned(fresh, name, require_filter=None).count() == 200
    assert read_partitioned(fresh, f"{namespace}.of_days", require_filter=None).count() == 200


def test_refresh_from_its_own_rows(spark, namespace):
    name = f"{namespace}.t"
    publish_table(spark.range(5), name)
    publish_table(spark.table(name).where("id > 2"), name)
    assert spark.table(name).count() == 2


def test_partitioned_table(spark, namespace):
    name = f"{namespace}.days"
    df = spark.sql(f"{DAYS} UNION ALL SELECT NULL, -1, 0")
    out = publish_table(df, name, partition_by=["d"])
    assert bag(out.na.drop()) == bag(df.na.drop()) and out.count() == 401
    assert out.where("d IS NULL").count() == 1
    assert out.columns == df.columns
    one = spark.table(name).where(F.col("d") == dt.date(2024, 1, 2))
    assert one.count() == 100 and "PartitionFilters: [isnotnull(d" in plan_text(one)


def test_partition_values_go_to_few_files(spark, tmp_path):
    path = f"{tmp_path}/t"
    write_partitioned(spark.sql(DAYS).repartition(8), path, partition_by=["d"])
    assert len(glob.glob(f"{path}/d=*/*.parquet")) == 4


def test_a_partition_with_too_many_rows_is_cut(spark, tmp_path):
    path = f"{tmp_path}/t"
    day = "if(id % 3 = 0, date'2024-01-01', date_add(date'2024-01-02', cast(id % 9 as int))) d"
    df = spark.range(0, 900_000, 1, 8).selectExpr(day, "id", "hash(id) k")
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "256k")
    try:
        out = write_partitioned(df, path, partition_by=["d"])
    finally:
        spark.conf.unset(key)
    assert len(glob.glob(f"{path}/d=2024-01-01/*.parquet")) > 3
    assert out.agg(F.count(F.lit(1)), F.count_distinct("id")).first() == (900_000, 900_000)


def test_clustered_files_have_narrow_ranges(spark, tmp_path):
    path = f"{tmp_path}/t"
    df = spark.range(0, 100_000, 1, 8).selectExpr("cast(hash(id) as bigint) k", "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_partitioned(df, path, cluster_by=["k"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spans = []
    for file in glob.glob(f"{path}/*.parquet"):
        low, high = spark.read.parquet(file).agg(F.min("k"), F.max("k")).first()
        spans.append((low, high))
    spans.sort()
    assert len(spans) == 8
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_one_frequent_cluster_value_fills_several_tasks(spark):
    hot = spark.range(0, 50_000, 1, 8).selectExpr("1 k", "id")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = arrange(hot, cluster_by=["k"]).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert max(r["count"] for r in sizes) < 25_000


def test_append_matches_columns_by_name(spark, namespace):
    name = f"{namespace}.t"
    write_table(spark.sql("SELECT 1 a, 'x' b"), name, "append")
    write_table(spark.sql("SELECT 'y' b, 2 a"), name, "append")
    assert bag(spark.table(name)) == [(1, "x"), (2, "y")]
    write_table(spark.sql("SELECT 3 a, 'z' b"), name, "overwrite")
    assert bag(spark.table(name)) == [(3, "z")]
    with pytest.raises(ValueError, match="columns"):
        append_table(spark.sql("SELECT 1 a"), name)
    with pytest.raises(ValueError, match="mode"):
        write_table(spark.range(1), name, "merge")


def test_append_to_a_partitioned_table(spark, namespace):
    name = f"{namespace}.days"
    publish_table(spark.sql(DAYS), name, partition_by=["d"])
    append_table(spark.sql("SELECT 7 k, date'2030-01-01' d, 1000L id"), name)
    assert spark.table(name).where("d = date'2030-01-01'").first().id == 1000
    verify_readable(spark, name)


def test_appended_partitions_get_few_files(spark, namespace):
    name = f"{namespace}.days"
    out = publish_table(spark.sql(DAYS), name, partition_by=["d"])
    before = len(out.inputFiles())
    append_table(spark.sql(DAYS).repartition(8), name)
    again = spark.table(name)
    assert again.count() == 800 and len(again.inputFiles()) <= before + 4


def test_staged_rows_have_no_lineage_and_go_afterwards(spark):
    with staged(spark.range(10).selectExpr("id * 2 v"), "t") as (frame, path):
        assert "Range" not in plan_text(frame) and frame.count() == 10
        assert path_exists(spark, path)
    assert not path_exists(spark, path)
    with pytest.raises(RuntimeError), staged(spark.range(1), "t") as (_, path):
        raise RuntimeError
    assert path_exists(spark, path)


def test_namespace(spark, tmp_path):
    ensure_namespace(spark, "ns_again", f"{tmp_path}/x")
    ensure_namespace(spark, "ns_again")
    assert spark.catalog.databaseExists("ns_again")


class Recorder:
    """Stands in for a frame and its V2 writer, noting the calls."""

    def __init__(self):
        self.calls = []

    def __getattr__(self, name):
        def call(*args):
            self.calls.append((name, *[a for a in args if isinstance(a, str)]))
            return self

        return call


def test_v2_statements(spark):
    frame = Recorder()
    write_v2(frame, "c.ns.t", partition_by=["d"], properties={"layer": "gold"})
    write_v2(frame, "c.ns.t", "append")
    assert frame.calls == [
        ("writeTo", "c.ns.t"),
        ("partitionedBy",),
        ("tableProperty", "layer", "gold"),
        ("createOrReplace",),
        ("writeTo", "c.ns.t"),
        ("append",),
    ]
    with pytest.raises(ValueError):
        write_v2(frame, "c.ns.t", "upsert")


def test_writers_choose_by_catalog(spark):
    assert not is_v2(spark, "ns.t")
    assert not is_v2(spark, "c.ns.t")
    spark.conf.set("spark.sql.catalog.c", "some.Catalog")
    try:
        assert is_v2(spark, "c.ns.t") and not is_v2(spark, "ns.t")
    finally:
        spark.conf.unset("spark.sql.catalog.c")


def test_bucketed_tables_need_no_exchange(spark, namespace):
    """Neither a grouping by the key nor a join of two such tables, also after a refresh."""
    rows = spark.range(0, 20_000, 1, 4).selectExpr("concat('c', id % 5000) k", "id")
    for name in ("a", "b"):
        publish_table(rows, f"{namespace}.{name}", bucket_by=["k"], checks=[Check.not_empty(name)])
        publish_table(rows.where("id > 9"), f"{namespace}.{name}", bucket_by=["k"])
    fresh = spark.newSession()
    fresh.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    a, b = (fresh.table(f"{namespace}.{name}") for name in "ab")
    assert "Exchange" in plan_text(a.groupBy("id").count())
    for df, n in ((a.groupBy("k").count(), 5000), (a.join(b, "k"), 79_930)):
        assert "Exchange" not in plan_text(df) and df.count() == n
    assert all(len(v.inputFiles()) == 8 for v in (a, b))
    publish_table(rows, f"{namespace}.a", bucket_by=["k"], buckets=16)
    publish_table(rows, f"{namespace}.a", bucket_by=["k"])
    assert len(spark.table(f"{namespace}.a").inputFiles()) == 16
    with pytest.raises(QualityError):
        publish_table(rows.where("id < 0"), f"{namespace}.a", bucket_by=["k"], checks=[Check.not_empty("a")])
    assert spark.table(f"{namespace}.a").count() == 20_000
    with pytest.raises(ValueError):
        publish_table(rows, f"{namespace}.a", bucket_by=["k"], cluster_by=["k"])
