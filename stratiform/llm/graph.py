"""Connected components of tables of links, by contraction over staged tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiform.llm.common import staged

TASK_ROWS = 2_000_000  # rows that are closed in one task


def roots(keys: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct nodes in order, and the smallest that each hangs together with."""
    names, node = np.unique(nodes, return_inverse=True)
    known, key = np.unique(keys, return_inverse=True)
    root = np.arange(len(names))
    while True:
        least = np.full(len(known), len(names))
        np.minimum.at(least, key, root[node])
        found = root.copy()
        np.minimum.at(found, root[node], least[key])
        while not np.array_equal(further := found[found], found):
            found = further
        if np.array_equal(found, root):
            return names, names[root]
        root = found


def _closed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts = [(b.column("key").to_numpy(), b.column("node").to_numpy()) for b in batches if b.num_rows]
    if parts:
        found = roots(*(np.concatenate(p) for p in zip(*parts, strict=True)))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["node", "root"])


def components(members: DataFrame, rows: int = TASK_ROWS) -> DataFrame:
    """``node`` and ``root``, the smallest node it hangs together with.

    ``members`` has a row for each ``node`` of each ``key``; both are numbers. Nodes with a key
    in common hang together. In every round a node hops to the first node of its keys, in an
    order by a hash that differs from round to round, and what hopped to one node goes on as
    that node; keys of one node go. A node that has a neighbour is the first of its keys in half
    of the rounds at most, so fewer nodes are left in each, and what is left of at most ``rows``
    rows is closed in one task. Rounds are few, as the driver keeps the plans, stages and tasks
    of each. Nodes of one key are reduced with partial aggregation: a key that holds a third of
    all rows is one small row per task.
    """
    left, hops = members.select("key", "node"), []
    while left.count() > rows:
        order = F.struct(F.xxhash64(F.lit(len(hops)), "node").alias("place"), "node")
        firsts = left.groupBy("key").agg(F.min(order).alias("first"), F.max(order).alias("last"))
        if hops:  # in the first round every node gets a row
            firsts = firsts.where("first.node != last.node")
        known = left.join(firsts.select("key", "first"), "key")
        hop = known.groupBy("node").agg(F.min("first").alias("first"))
        hop = staged(hop.select("node", F.col("first.node").alias("next")), "hops")
        known = known if hops else left
        hops.append(hop)
        left = staged(known.join(hop, "node").select("key", F.col("next").alias("node")).distinct(), "left")
    found = staged(left.coalesce(1).mapInArrow(_closed, "node bigint, root bigint"), "closed")
    if not hops:
        return found
    while hops:
        after = found.withColumnRenamed("node", "next")
        joined = hops.pop().join(after, "next", "left")
        found = staged(joined.select("node", F.coalesce("root", "next").alias("root")), "found")
    # What hopped away was not always the larger node.
    least = found.groupBy("root").agg(F.min("node").alias("least"))
    return staged(found.join(least, "root").select("node", F.col("least").alias("root")), "components")
