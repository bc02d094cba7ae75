from stratiform.functions.casts import (
    INT64,
    NUMERIC,
    STRING,
    TIMESTAMP,
    safe,
    strict,
    utc_date,
)

__all__ = ["INT64", "NUMERIC", "STRING", "TIMESTAMP", "safe", "strict", "utc_date"]
