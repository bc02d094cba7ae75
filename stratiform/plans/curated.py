"""Curated and gold models of the layered run."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiform.functions import INT64, NUMERIC, STRING, TIMESTAMP, safe
from stratiform.operators.lineage import now, with_lineage


def sample_curated(raw: DataFrame, env: str = "dev", *, at: dt.datetime | None = None) -> DataFrame:
    """Tolerant typed copy: a value that does not fit becomes NULL."""
    typed = raw.select(
        safe(raw, "id", INT64).alias("id"),
        safe(raw, "name", STRING).alias("name"),
        safe(raw, "amount", NUMERIC).alias("amount"),
        safe(raw, "event_ts", TIMESTAMP).alias("ts"),
    )
    return with_lineage(
        typed, stamp="ingestion_ts", at=at, source_object="ext_sample_parquet", env=env
    )


def amount_by_name_gold(
    curated: DataFrame, env: str = "dev", *, at: dt.datetime | None = None
) -> DataFrame:
    """Rows, amount and time span per name."""
    return (
        curated.groupBy("name")
        .agg(
            F.count(F.lit(1)).alias("nb_rows"),
            F.sum("amount").alias("total_amount"),
            F.min("ts").alias("first_ts"),
            F.max("ts").alias("last_ts"),
        )
        .withColumns({"built_ts": now(at), "env": F.lit(env)})
    )
