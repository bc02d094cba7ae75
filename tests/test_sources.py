import datetime as dt

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import RAW, at
from pyspark.sql import functions as F

from stratiform import EnvConfig, session
from stratiform.session import (
    DEFAULT_PROFILE,
    diagnostics,
    fresh_path,
    prepare,
    session_conf,
    shared_dir,
    shuffle_partitions,
    size_shuffles,
    size_shuffles_for,
)
from stratiform.sources import (
    PartitionFilterRequired,
    RawSource,
    SourceFormatUnavailable,
    SourceUnavailable,
    declare_raw,
    declare_sources,
    enabled_sources,
    env_check,
    land_raw,
    one_row,
    preview,
    read_curated,
    read_partitioned,
    read_query,
    read_raw,
    read_table,
    seed_raw,
)
from stratiform.sources.readers import partition_columns, plan_text, restricts


@pytest.fixture
def sample(raw):
    return raw(
        (1, "alex", 10.5, at("2024-01-01", "01:02:03.456789")),
        (2, 'with "quotes", commas', 20.0, at("2024-01-02")),
        (None, None, None, None),
    )


def rows(df):
    return sorted((tuple(r) for r in df.select("id", "name", "amount", "event_ts").collect()), key=str)


@pytest.mark.parametrize(
    "kind, fmt", [("parquet", "PARQUET"), ("csv", "CSV"), ("json", "NEWLINE_DELIMITED_JSON")]
)
def test_formats_round_trip(spark, tmp_path, sample, kind, fmt):
    path = land_raw(sample, str(tmp_path), "sales", "sample", file_format=kind)
    assert path == f"{tmp_path}/domain=sales/dataset=sample"
    declared = RawSource("s", (path,), fmt, schema=RAW)
    assert rows(read_raw(spark, declared)) == rows(sample)
    detected = read_raw(spark, RawSource("s", (path,), fmt))
    assert set(detected.columns) == set(sample.columns)
    assert dict(detected.dtypes)["amount"] == "double"


def test_hive_partitions_need_the_base_path(spark, tmp_path, sample):
    dated = sample.where("id IS NOT NULL").withColumn("ingest_date", F.to_date("event_ts"))
    path = land_raw(dated, str(tmp_path), "sales", "orders", partition_by=["ingest_date"])
    leaf = (f"{path}/*/*.parquet",)
    assert "domain" not in read_raw(spark, RawSource("o", leaf)).columns
    full = read_raw(spark, RawSource("o", leaf, base_path=str(tmp_path)))
    assert {"domain", "dataset", "ingest_date"} <= set(full.columns)
    first = full.where(F.col("ingest_date") == dt.date(2024, 1, 1))
    assert first.count() == 1
    assert "PartitionFilters: [isnotnull(ingest_date" in plan_text(first)


def test_seed_two_datasets_from_one_frame(spark, tmp_path, sample):
    paths = seed_raw(sample, str(tmp_path), "sales", ["orders", "sales_transactions"])
    assert [spark.read.parquet(p).count() for p in paths] == [3, 3]


def test_landing_nothing_is_noticed(spark, tmp_path):
    days = spark.sql("SELECT id, date'2024-01-01' d FROM range(5)")
    for _ in range(2):
        path = land_raw(days, str(tmp_path), "sales", "days", partition_by=["d"])
    assert spark.read.parquet(path).count() == 10
    with pytest.raises(OSError, match="nothing was written"):
        land_raw(days.where("id > 9"), str(tmp_path), "sales", "days", partition_by=["d"])


def test_nanosecond_timestamps(spark, tmp_path):
    values = [1_704_067_200_123_456_789, -1, None]
    table = pa.table({"id": [1, 2, 3], "event_ts": pa.array(values, pa.timestamp("ns", tz="UTC"))})
    pq.write_table(table, tmp_path / "nanos.parquet")
    source = RawSource("n", (str(tmp_path / "nanos.parquet"),), nanos=("event_ts",))
    df = read_raw(spark, source)
    assert dict(df.dtypes)["event_ts"] == "timestamp"
    micros = [r[0] for r in df.orderBy("id").select(F.unix_micros("event_ts")).collect()]
    assert micros == [1_704_067_200_123_456, -1, None]


@pytest.mark.parametrize("fmt", ["AVRO", "ICEBERG"])
def test_missing_readers_are_named(spark, tmp_path, fmt):
    with pytest.raises(SourceFormatUnavailable, match=fmt):
        read_raw(spark, RawSource("s", (str(tmp_path),), fmt))


def test_source_declarations_are_validated():
    with pytest.raises(ValueError, match="format"):
        RawSource("s", ("x",), "XML")
    with pytest.raises(ValueError, match="uris"):
        RawSource("s", ())
    with pytest.raises(ValueError, match="schema"):
        RawSource("s", ("x",), "CSV", autodetect=False)


def test_optional_sources(spark, tmp_path, sample):
    path = land_raw(sample, str(tmp_path), "sales", "sample")
    names = ("sample_ext", "orders", "sales_transactions")
    sources = tuple(RawSource(n, (path,)) for n in names)
    off, on = EnvConfig(sources=sources), EnvConfig(sources=sources, enable_sales_orders=True)
    assert [s.name for s in enabled_sources(off)] == ["sample_ext"]
    assert [s.name for s in enabled_sources(on)] == list(names)


@pytest.fixture
def raw_env(spark, tmp_path):
    cfg = EnvConfig(sandbox=tmp_path.name.replace("-", "_"), enable_sales_orders=True)
    yield lambda *sources: EnvConfig(
        sandbox=cfg.sandbox, enable_sales_orders=True, sources=sources
    )
    spark.sql(f"DROP NAMESPACE IF EXISTS {cfg.namespace('raw_ext')} CASCADE")


def test_raw_tables_are_there_for_other_sessions(spark, tmp_path, sample, raw_env):
    path = land_raw(sample, str(tmp_path), "sales", "sample")
    glob = (f"{tmp_path}/domain=*/dataset=sample/*.parquet",)
    cfg = raw_env(RawSource("sample_ext", (path,)), RawSource("orders", glob))
    names = declare_sources(spark, cfg)
    assert names == [f"{cfg.namespace('raw_ext')}.{n}" for n in ("sample_ext", "orders")]
    other = prepare(spark.newSession())
    for name in names:
        assert rows(other.table(name)) == rows(sample)
    land_raw(sample.where("id = 1"), str(tmp_path), "sales", "sample")
    declare_sources(spark, cfg)
    assert [spark.table(name).count() for name in names] == [4, 4]
    spark.sql(f"DROP TABLE {names[0]}")
    assert spark.read.parquet(path).count() == 4


def test_raw_tables_have_the_partitions_of_their_folders(spark, tmp_path, sample, raw_env):
    dated = sample.withColumn("day", F.to_date("event_ts")).withColumn("at", F.lit("9:30 / a=b%"))
    path = land_raw(dated, str(tmp_path), "sales", "orders", partition_by=["day", "at"])
    land_raw(sample, str(tmp_path), "other", "orders")
    source = RawSource("orders", (f"{path}/*/*/*.parquet",), base_path=str(tmp_path))
    (name,) = declare_sources(spark, raw_env(source))
    table = prepare(spark.newSession()).table(name)
    assert table.columns == [*sample.columns, "domain", "dataset", "day", "at"]
    assert rows(table) == rows(sample)
    assert {r.at for r in table.select("at").collect()} == {"9:30 / a=b%"}
    one = table.where(F.col("day") == dt.date(2024, 1, 1))
    assert one.count() == 1 and "InMemoryFileIndex(1 paths)" in plan_text(one, "simple")
    later = sample.limit(1).withColumn("day", F.lit("2030-05-05")).withColumn("at", F.lit("x"))
    land_raw(later, str(tmp_path), "sales", "orders", partition_by=["day", "at"])
    declare_raw(spark, source, name)
    assert spark.table(name).where("day = date'2030-05-05'").count() == 1
    assert spark.table(name).count() == 4


def test_raw_tables_of_other_formats_and_several_places(spark, tmp_path, sample, raw_env):
    clean = sample.where("id IS NOT NULL")
    paths = [land_raw(clean, str(tmp_path), d, "s", file_format="csv") for d in ("a", "b")]
    json = land_raw(sample, str(tmp_path), "j", "s", file_format="json")
    cfg = raw_env(
        RawSource("orders", tuple(paths), "CSV", schema=RAW),
        RawSource("sample_ext", (json,), "NEWLINE_DELIMITED_JSON", schema=RAW),
    )
    orders, sample_ext = declare_sources(spark, cfg)
    other = prepare(spark.newSession())
    assert rows(other.table(orders)) == sorted(rows(clean) * 2, key=str)
    assert rows(other.table(sample_ext)) == rows(sample)


def test_a_changed_source_replaces_its_table(spark, tmp_path, sample, raw_env):
    first = land_raw(sample, str(tmp_path), "a", "s")
    second = land_raw(sample.withColumn("more", F.lit(1)), str(tmp_path), "b", "s")
    for path, columns in ((first, 4), (second, 5), (second, 5)):
        (name,) = declare_sources(spark, raw_env(RawSource("orders", (path,))))
        assert len(spark.table(name).columns) == columns


@pytest.fixture
def partitioned(spark, tmp_path):
    path = f"{tmp_path}/fct"
    spark.sql(
        "SELECT * FROM VALUES (date'2024-01-01', 1), (date'2024-01-02', 2), (NULL, 3) t(d, v)"
    ).write.partitionBy("d").parquet(path)
    return path


def test_guarded_read(spark, partitioned):
    with pytest.raises(PartitionFilterRequired):
        read_partitioned(spark, partitioned)
    with pytest.raises(PartitionFilterRequired):
        read_partitioned(spark, partitioned, F.col("v") > 1)
    with pytest.raises(PartitionFilterRequired):
        read_partitioned(spark, partitioned, F.col("d").isNotNull())
    day = read_partitioned(spark, partitioned, F.col("d") >= dt.date(2024, 1, 2))
    assert [r.v for r in day.collect()] == [2]
    assert read_partitioned(spark, partitioned, F.col("d").isNull()).first().v == 3
    assert read_partitioned(spark, partitioned, require_filter=False).count() == 3
    assert EnvConfig("prod").require_partition_filter
    assert not EnvConfig("dev").require_partition_filter


def test_guarded_source(spark, partitioned):
    source = RawSource("fct", (partitioned,), require_partition_filter=True)
    with pytest.raises(PartitionFilterRequired):
        read_raw(spark, source)
    with pytest.raises(PartitionFilterRequired):
        read_raw(spark, source, F.col("v") > 1)
    assert read_raw(spark, source, F.col("d") == dt.date(2024, 1, 2)).first().v == 2
    free = RawSource("free", (partitioned,))
    assert read_raw(spark, free, F.col("v") > 1).count() == 2


def test_a_guarded_source_has_a_guarded_table(spark, partitioned, raw_env):
    source = RawSource("orders", (partitioned,), require_partition_filter=True)
    cfg = raw_env(source)
    (name,) = declare_sources(spark, cfg)
    with pytest.raises(PartitionFilterRequired):
        read_table(spark.newSession(), name)
    assert read_table(spark, name, F.col("d") == dt.date(2024, 1, 2)).sample[0]["v"] == 2


def test_partition_columns_in_predicates(spark, namespace):
    spark.sql(f"CREATE TABLE {namespace}.days (v INT, d DATE) USING parquet PARTITIONED BY (d)")
    columns = partition_columns(spark, f"{namespace}.days")
    assert columns == ["d"]
    days = spark.table(f"{namespace}.days")
    day = F.col("d") > dt.date(2024, 1, 1)
    assert restricts(days.where(day), columns)
    assert restricts(days.where(day & (F.col("v") > 1)).where("v < 9"), columns)
    assert restricts(days.where(F.col("d").isNull()), columns)
    for weak in ("v > 1", "d IS NOT NULL", "concat(v, 'd') = 'd'", "d = date'2024-01-01' OR v = 1"):
        assert not restricts(days.where(weak), columns)
    assert not restricts(days, columns)


def test_queries_tables_and_previews(spark, namespace):
    spark.range(20).write.saveAsTable(f"{namespace}.numbers")
    read = read_table(spark, f"{namespace}.numbers")
    assert read.schema == {"id": "bigint"} and len(read.sample) == 5
    assert preview(read.frame).count() == 5 and preview(read.frame, 10).count() == 10
    sql = f"SELECT id FROM {namespace}.numbers WHERE id < :top"
    assert read_query(spark, sql, args={"top": 3}).count() == 3
    with pytest.raises(ValueError):
        read_query(spark, sql, args={"top": 3}, jdbc={"url": "jdbc:x"})


def test_curated_passthrough(spark, tmp_path, sample):
    sample.write.parquet(f"{tmp_path}/customer")
    cfg = EnvConfig(curated_root=str(tmp_path))
    assert rows(read_curated(spark, cfg, "customer")) == rows(sample)
    with pytest.raises(SourceUnavailable):
        read_curated(spark, cfg, "orders")
    with pytest.raises(SourceUnavailable):
        read_curated(spark, EnvConfig(), "customer")


def test_constant_rows(spark):
    assert [tuple(r) for r in one_row(spark).collect()] == [(1,)]
    assert env_check(spark, EnvConfig("staging")).first().asDict() == {
        "env": "staging",
        "raw_ext_dataset": "raw_ext_staging",
        "analytics_dataset": "analytics_staging",
    }


def test_names():
    cfg = EnvConfig()
    assert cfg.env == "dev"
    assert [cfg.namespace(x) for x in ("curated", "curated_ext", "curated_iceberg")] == [
        "curated_dev",
        "curated_ext_dev",
        "curated_iceberg_dev",
    ]
    assert cfg.namespace("enterprise") == "enterprise_dev"
    assert EnvConfig(catalog="c").table("analytics", "t") == "c.analytics_dev.t"
    assert EnvConfig(sandbox="me").table("analytics", "t") == "analytics_dev_me.t"
    with pytest.raises(ValueError):
        EnvConfig("test")
    with pytest.raises(ValueError):
        cfg.namespace("bronze")


def test_session_conf():
    conf = session_conf()
    assert DEFAULT_PROFILE == "dev_small" and conf["spark.executor.memory"] == "4g"
    assert conf["spark.sql.session.timeZone"] == "UTC"
    assert not any(k.startswith("spark.sql.catalog") for k in conf)
    with_catalog = session_conf(
        "dev_tiny", catalog="w", warehouse="s3a://w", extras={"spark.executor.memory": "9g", "a": ""}
    )
    assert with_catalog["spark.executor.memory"] == "9g"
    assert with_catalog["spark.sql.catalog.w.warehouse"] == "s3a://w"
    assert "a" not in with_catalog and "spark.jars.packages" not in with_catalog
    with pytest.raises(KeyError):
        session_conf("huge")
    with pytest.raises(KeyError, match="spark.driver.memory"):
        session_conf({"spark.driver.cores": "1"})
    with pytest.raises(ValueError):
        session_conf(catalog="w")


def test_shuffles_start_as_wide_as_their_input(spark, tmp_path):
    assert shuffle_partitions(0) == 200
    assert shuffle_partitions(10**12) == 3726
    assert shuffle_partitions(10**15) == 3_725_291
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    size_shuffles(spark, [str(tmp_path)])
    assert spark.conf.get(initial, None) is None  # this session sets its own number
    fresh = spark.newSession()
    fresh.conf.unset("spark.sql.shuffle.partitions")
    if fresh.conf.get("spark.sql.shuffle.partitions", None) is None:
        size_shuffles(fresh, [str(tmp_path), f"{tmp_path}/missing"])
        assert fresh.conf.get(initial) == "200"


def test_shuffles_start_as_wide_as_the_plan(spark, namespace, monkeypatch):
    """Only the partitions of a table that the frame needs count, and nothing is listed."""
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    monkeypatch.setattr(session, "SHUFFLE_BYTES", 100)
    monkeypatch.setattr(session, "LEAST_PARTITIONS", 1)
    monkeypatch.setattr(session, "size_in_bytes", None)
    fresh = spark.newSession()
    fresh.conf.unset("spark.sql.shuffle.partitions")
    days = fresh.range(4000).selectExpr("id", "id % 40 d")
    days.repartition(1).write.partitionBy("d").saveAsTable(f"{namespace}.days")
    days = fresh.table(f"{namespace}.days")
    if fresh.conf.get("spark.sql.shuffle.partitions", None) is None:
        size_shuffles_for(days.where("d = 1").groupBy("id").count())
        narrow = int(fresh.conf.get(initial))
        size_shuffles_for(days.groupBy("id").count())
        wide = int(fresh.conf.get(initial))
        assert 1 <= narrow < wide / 10
        size_shuffles_for(days.where("d = 1").groupBy("id").count())
        assert int(fresh.conf.get(initial)) == wide
    size_shuffles_for(spark.range(5))
    assert spark.conf.get(initial, None) is None


def test_shared_dir_is_the_one_the_session_names(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert fresh_path(spark, "x") != fresh_path(spark, "x")
    found = diagnostics(spark, "w")
    assert found["spark.version"] == spark.version and found["spark.sql.catalog.w"] == ""
