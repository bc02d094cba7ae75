"""Left outer equi-join that stays whole and parallel when keys are hot on the right.

Adaptive execution splits a skewed *left* side of a left outer join by itself. It
cannot split the right side, because each left row must see all its matches to know
that it has any. So right keys with very many rows take another way:

* ``hot`` lists all right keys above ``hot_rows`` rows. There are as many as that
  goes into the right side at most; the optimizer broadcasts the list by its size or not.
* All other keys: an ordinary left outer join.
* Hot keys: the right rows are dealt into cells, the left rows are copied to each
  cell of their key, and an inner join runs per (key, cell). Inner is enough, for a
  hot key has right rows by definition, so no left row of it can stay unmatched.

Cells are dealt by a hash of the row, which gives the same cell again when a lost
task is recomputed. Exact copies would all hash to one cell; they are first counted,
then split into pieces of bounded multiplicity, and multiplied out after the join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fanout_left_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    *,
    hot_rows: int = 1_000_000,
    piece: int = 256,
    where: Column | None = None,
) -> DataFrame:
    """All pairs of rows with equal, non-NULL keys, plus the left rows without any.

    ``on`` names columns both sides have; their other columns must differ in name. ``where``
    is a condition on columns of ``on``: it is put on both sides before keys are counted, so
    that it reaches every scan.
    """
    on = list(on)
    if where is not None:
        left, right = left.where(where), right.where(where)
    hot = hot_keys(right, on, hot_rows=hot_rows)
    keys = hot.select(*on)
    ordinary = left.join(keys, on, "left_anti").join(right.join(keys, on, "left_anti"), on, "left")
    return ordinary.unionByName(_hot_pairs(left, right, hot, on, piece).select(*ordinary.columns))


def hot_keys(df: DataFrame, on: Sequence[str], *, hot_rows: int) -> DataFrame:
    """Keys with more than ``hot_rows`` rows and the cells to deal each into.

    Counting combines before it shuffles, so a hot key costs one row per task.
    """
    complete = F.lit(True)
    for name in on:
        complete = complete & F.col(name).isNotNull()
    return (
        df.where(complete)
        .groupBy(*on)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .where(F.col("_rows") > hot_rows)
        .select(*on, F.ceil(F.col("_rows") / F.lit(hot_rows)).cast("int").alias("_cells"))
    )


def _hot_pairs(left, right, hot, on, piece) -> DataFrame:
    left_columns, right_columns = left.columns, right.columns
    dealt_right = (
        _counted_pieces(right.join(hot, on, "inner"), piece)
        .withColumn("_cell", _cell_of(right_columns))
        .select(*right_columns, "_cell", F.col("_copies").alias("_right_copies"))
    )
    copied_left = _counted_pieces(left.join(hot, on, "inner"), piece).select(
        *left_columns,
        F.explode(F.sequence(F.lit(0), F.col("_cells") - 1)).alias("_cell"),
        F.col("_copies").alias("_left_copies"),
    )
    pairs = copied_left.join(dealt_right, [*on, "_cell"], "inner")
    copies = (F.col("_left_copies") * F.col("_right_copies")).cast("int")
    return pairs.withColumn("_copy", F.explode(F.array_repeat(F.lit(True), copies)))


def _counted_pieces(df: DataFrame, piece: int) -> DataFrame:
    """Distinct rows with their number of copies, at most ``piece`` copies per row out."""
    return (
        df.groupBy(*df.columns)
        .agg(F.count(F.lit(1)).alias("_total"))
        .withColumn("_piece", F.explode(F.expr(f"sequence(0L, (_total - 1) div {piece})")))
        .withColumn("_copies", F.expr(f"least({piece}L, _total - _piece * {piece}L)"))
        .drop("_total")
    )


def _cell_of(columns: Sequence[str]):
    return F.pmod(F.xxhash64(*columns, "_piece"), F.col("_cells").cast("bigint")).cast("int")
