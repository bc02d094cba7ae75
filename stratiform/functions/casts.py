"""Strict and tolerant casts to the four column types the models use.

``strict`` fails the job on a value the type cannot hold; ``safe`` turns such a
value into NULL. Both give the same answer with ANSI mode on or off, and both stay
ordinary JVM expressions. A cast that cannot fail is left as a plain cast, so
that filters on its result still reach the file scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

STRING = "string"
INT64 = "bigint"
NUMERIC = "decimal(38,9)"
TIMESTAMP = "timestamp"

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)
_TEMPORAL = (T.TimestampType, T.TimestampNTZType, T.DateType)
_CASTABLE = (STRING, INT64, NUMERIC, TIMESTAMP)

# Text is a timestamp only when it starts with a whole date; a bare year or a
# bare time of day is not.
_STARTS_WITH_DATE = r"^\s*\d{4}-\d{1,2}-\d{1,2}"


def _cannot_fail(source: T.DataType, target: str) -> bool:
    if target == STRING:
        return True
    if target == INT64:
        return isinstance(source, _WHOLE)
    if target == NUMERIC:
        fits = isinstance(source, T.DecimalType) and source.precision - source.scale <= 29
        return fits or isinstance(source, _WHOLE)
    return isinstance(source, _TEMPORAL)


def _attempt(value: str, source: T.DataType, target: str) -> str:
    """The cast with NULL for whatever does not fit."""
    if target == INT64 and isinstance(source, _FRACTIONAL):
        value = f"round({value})"  # halves go away from zero, as integer casts must
    if target == TIMESTAMP and isinstance(source, T.StringType):
        value = f"CASE WHEN {value} RLIKE r'{_STARTS_WITH_DATE}' THEN {value} END"
    return f"try_cast({value} AS {target})"


def safe(df: DataFrame, name: str, target: str) -> Column:
    """Cast column ``name``; a value that does not fit becomes NULL."""
    return F.expr(safe_sql(df.schema, name, target))


def safe_sql(schema: T.StructType, name: str, target: str) -> str:
    """:func:`safe` as SQL text, for definitions that outlive the session."""
    source, value = _source_type(schema, name, target), quoted(name)
    if _cannot_fail(source, target):
        return f"CAST({value} AS {target})"
    return _attempt(value, source, target)


def strict(df: DataFrame, name: str, target: str) -> Column:
    """Cast column ``name``; a value that does not fit fails the query.

    This includes NaN and infinities on the way to NUMERIC, which a plain cast
    would quietly turn into NULL.
    """
    return F.expr(strict_sql(df.schema, name, target))


def strict_sql(schema: T.StructType, name: str, target: str) -> str:
    """:func:`strict` as SQL text."""
    source, value = _source_type(schema, name, target), quoted(name)
    if _cannot_fail(source, target):
        return f"CAST({value} AS {target})"
    label = name.replace("\\", "\\\\").replace("'", "\\'")
    problem = f"concat('cannot cast {label} to {target}: ', CAST({value} AS STRING))"
    return (
        f"coalesce({_attempt(value, source, target)}, "
        f"CASE WHEN {value} IS NOT NULL THEN CAST(raise_error({problem}) AS {target}) END)"
    )


def quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def utc_date(timestamp: Column) -> Column:
    """Date of a timestamp; the session zone is UTC."""
    return F.to_date(timestamp)


def _source_type(schema: T.StructType, name: str, target: str) -> T.DataType:
    """Type of the column; a number is no point in time and a point in time no number."""
    if target not in _CASTABLE:
        raise ValueError(f"unsupported target type {target!r}, expected one of {_CASTABLE}")
    source = schema[name].dataType
    numbers = (*_WHOLE, *_FRACTIONAL)
    refused = {TIMESTAMP: numbers, INT64: _TEMPORAL, NUMERIC: _TEMPORAL}
    if isinstance(source, refused.get(target, ())):
        raise TypeError(f"{name}: no cast from {source.simpleString()} to {target}")
    return source
