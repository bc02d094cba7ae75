"""Technical columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def now(at: dt.datetime | None = None) -> Column:
    """Wall clock of the query, the same for all its rows; ``at`` replaces it in tests."""
    return F.current_timestamp() if at is None else F.lit(at).cast("timestamp")


def with_lineage(
    df: DataFrame, *, stamp: str, at: dt.datetime | None = None, **tags: str
) -> DataFrame:
    """Append a load timestamp called ``stamp`` and constant text columns."""
    return df.withColumns({stamp: now(at), **{k: F.lit(v) for k, v in tags.items()}})
