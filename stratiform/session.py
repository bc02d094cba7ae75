"""Session settings, shared scratch space and diagnostics."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from stratiform.storage import estimated_bytes, path_exists, size_in_bytes

# Sizing profiles. Anything else a deployment needs goes in `extras`.
PROFILES = {
    "dev_tiny": {
        "spark.driver.cores": "1",
        "spark.driver.memory": "2g",
        "spark.executor.instances": "2",
        "spark.executor.cores": "1",
        "spark.executor.memory": "2g",
        "spark.dynamicAllocation.executorAllocationRatio": "0.1",
    },
    "dev_small": {
        "spark.driver.cores": "4",
        "spark.driver.memory": "4g",
        "spark.executor.instances": "2",
        "spark.executor.cores": "4",
        "spark.executor.memory": "4g",
        "spark.dynamicAllocation.executorAllocationRatio": "0.2",
    },
    "dev_medium": {
        "spark.driver.cores": "4",
        "spark.driver.memory": "8g",
        "spark.executor.instances": "2",
        "spark.executor.cores": "4",
        "spark.executor.memory": "8g",
        "spark.dynamicAllocation.executorAllocationRatio": "0.3",
    },
}
DEFAULT_PROFILE = "dev_small"
REQUIRED_SIZING = (
    "spark.driver.cores",
    "spark.driver.memory",
    "spark.executor.instances",
    "spark.executor.cores",
    "spark.executor.memory",
)

# What every job relies on, whatever its size.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    # Folders are listed in so many tasks, not in one for each of thousands.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "256",
    # A map task recomputed after an executor loss may write its rows in another
    # order; compare checksums and rerun the consumers when contents differ.
    "spark.sql.shuffle.orderIndependentChecksum.enabled": "true",
    "spark.sql.shuffle.orderIndependentChecksum.enableFullRetryOnMismatch": "true",
}


def session_conf(
    profile: str | dict[str, str] | None = DEFAULT_PROFILE,
    *,
    catalog: str | None = None,
    warehouse: str | None = None,
    packages: str | None = None,
    checkpoint_dir: str | None = None,
    extras: dict[str, str] | None = None,
) -> dict[str, str]:
    """Spark properties of a job: engine defaults, catalog, sizing, extras (extras win).

    The result feeds ``SparkSession.builder.config`` or ``spark-submit --conf``.
    Empty values are left out. Without a profile the cluster's own sizes hold.
    """
    if profile is None:
        sizing = {}
    elif isinstance(profile, str):
        if profile not in PROFILES:
            raise KeyError(f"unknown profile {profile!r}, available: {sorted(PROFILES)}")
        sizing = PROFILES[profile]
    else:
        sizing = profile
    missing = [k for k in REQUIRED_SIZING if profile is not None and not sizing.get(k)]
    if missing:
        raise KeyError(f"profile lacks {missing}")
    conf: dict[str, str | None] = dict(ENGINE_CONF)
    conf["spark.checkpoint.dir"] = checkpoint_dir
    if catalog:
        if not warehouse:
            raise ValueError(f"catalog {catalog!r} needs a warehouse location")
        conf["spark.jars.packages"] = packages
        conf["spark.sql.extensions"] = (
            "org.apache.iceberg.spark.extensions.IcebergSparkSessionExtensions"
        )
        conf[f"spark.sql.catalog.{catalog}"] = "org.apache.iceberg.spark.SparkCatalog"
        conf[f"spark.sql.catalog.{catalog}.type"] = "hadoop"
        conf[f"spark.sql.catalog.{catalog}.warehouse"] = warehouse
    conf.update(sizing)
    conf.update(extras or {})
    return {k: str(v) for k, v in conf.items() if v is not None and str(v).strip()}


def build_session(app_name: str, conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in (conf or ENGINE_CONF).items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Settings the models need of any session.

    Dates are UTC dates, so the zone is pinned before a timestamp becomes a date.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


# Adaptive execution merges small shuffle partitions but never adds any, so a shuffle
# starts from a number that fits its input: this many bytes each, and some at least.
SHUFFLE_BYTES = 256 * 1024**2
LEAST_PARTITIONS = 200
# A join counts as the product of its sides, which says nothing; 25 TB of input need as many.
MOST_ESTIMATED = 100_000
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_MARKER = "stratiform.initialPartitionNum"


def shuffle_partitions(input_bytes: int) -> int:
    return max(-(-input_bytes // SHUFFLE_BYTES), LEAST_PARTITIONS)


def size_shuffles(spark: SparkSession, paths: Iterable[str]) -> SparkSession:
    """Start shuffles wide enough for the files at ``paths``.

    A number of shuffle partitions the session sets itself stays as it is; one that
    an earlier call set here does not.
    """
    if _sized_here(spark):
        total = sum(size_in_bytes(spark, p) for p in paths if path_exists(spark, p))
        _start_with(spark, shuffle_partitions(total))
    return spark


def size_shuffles_for(df: DataFrame) -> DataFrame:
    """Start shuffles wide enough for what a frame reads, by the optimizer's estimate.

    Nothing is listed for it, and of a table in partitions only those that the frame needs
    count. Frames that run side by side share the setting, so it grows only: adaptive
    execution merges partitions, it adds none.
    """
    spark = df.sparkSession
    if _sized_here(spark):
        needed = -(-estimated_bytes(df) // SHUFFLE_BYTES)
        known = int(spark.conf.get(_MARKER, None) or 0)
        _start_with(spark, max(min(needed, MOST_ESTIMATED), LEAST_PARTITIONS, known))
    return df


def _sized_here(spark: SparkSession) -> bool:
    fixed = spark.conf.get("spark.sql.shuffle.partitions", None)
    return not fixed and spark.conf.get(_INITIAL, None) == spark.conf.get(_MARKER, None)


def _start_with(spark: SparkSession, partitions: int) -> None:
    for key in (_INITIAL, _MARKER):
        spark.conf.set(key, str(partitions))


@functools.lru_cache(maxsize=1)
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="stratiform-")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can read and write, as the cluster names it.

    Only a local session, where driver and executors share one machine, may fall
    back to a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    configured = configured or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    configured = configured or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return _local_scratch()
    raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing has used before."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def diagnostics(spark: SparkSession, catalog: str | None = None) -> dict[str, str]:
    """Version, extensions and catalog settings, for the top of a job log."""
    keys = ["spark.sql.extensions", "spark.checkpoint.dir"]
    if catalog:
        base = f"spark.sql.catalog.{catalog}"
        keys += [base, f"{base}.type", f"{base}.warehouse"]
    found = {"spark.version": spark.version}
    found.update({k: spark.conf.get(k, "") or "" for k in keys})
    return found
