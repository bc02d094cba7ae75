"""Jaccard join of documents as a join in a metric space.

The distance of two documents is one minus the Jaccard index of their sets of word
shingles; documents within ``EPS`` link. The join goes through three kinds of regions:

1. Equal sets are one point. Its smallest id stands for all of them.
2. Unrelated documents are all at distance 1 from each other, where document pivots cannot
   tell them apart. The first pivots therefore are single shingles, of a fixed share of the
   hash space. A point lies in the region of its rarest pivot shingle, and the window of
   links that its partners can lack, a tenth of its shingles, copies it to the regions of
   the next ones. Sizes are distances from the empty set: regions are cut into rings of
   sizes, and a point near the upper edge of its ring is also in the next one. Copies are ids only; a point whose windows hold no one else is done. Too
   few pivots in a point: it also takes part in a round where every shingle is one.
3. Points whose windows meet, directly or through others, are a region of documents. In it,
   windows are drawn again over all shingles of its points, with their rarity in the region.
   What still hangs together has documents as pivots: each point goes to its nearest pivot's Voronoi region, and to every
   region whose pivot is at most ``2 * EPS`` further away, which by the triangle inequality
   holds all its partners. Regions are joined again, in the same way, down to leaves that
   are compared pair by pair, except for pairs that are already connected. Regions too
   large for a task are divided by pivots in distributed rounds, and those that pivots
   cannot divide are compared in pairs of blocks.

Documents without words have an empty set and are their own component, as are null texts.
Repeated rows are repeated in the result; a row without an id has no component. Other
columns are not read. An empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratiform.llm.common import let, staged, words
from stratiform.llm.graph import components

# Documents link when 100 * intersection >= PERCENT * union.
PERCENT = 90
WIDTH = 3
PIVOT_SPARE = 0.05  # of the hash space, besides the share of shingles that a partner may lack
TASK_ELEMENTS = 4_000_000  # shingles of one region in one task
PIVOTS = 8
RING = 4  # width of a ring of sizes, in steps from a document to its largest partners
LEAF = 24


def _below(percent: int) -> Column:
    """The bound of the hashes of shingle pivots."""
    return F.lit(-(1 << 63) + int(((100 - percent) / 100 + PIVOT_SPARE) * (1 << 64)))


def shingles(text: Column, width: int = WIDTH) -> Column:
    """Sorted hashes of the distinct shingles of a text, in lower case for A to Z."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

    def of(w):
        def at(i):
            return F.xxhash64(*[F.get(w, i + k) for k in range(width)])

        windows = F.transform(F.sequence(F.lit(0), F.size(w) - width), at)
        short = F.when(F.size(w) == 0, F.array().cast("array<bigint>")).otherwise(
            F.array(F.xxhash64(w))
        )
        return F.when(F.size(w) >= width, windows).otherwise(short)

    lowered = F.translate(F.coalesce(text, F.lit("")), upper, upper.lower())
    return F.sort_array(F.array_distinct(let(words(lowered), of)))


class Links:
    """Union-find over the points of one region."""

    def __init__(self, size: int):
        self.root = np.arange(size)

    def find(self, k: int) -> int:
        while self.root[k] != k:
            self.root[k] = self.root[self.root[k]]
            k = self.root[k]
        return k

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        self.root[max(a, b)] = min(a, b)

    def roots(self, points: np.ndarray) -> np.ndarray:
        found = self.root[points]
        while not np.array_equal(further := self.root[found], found):
            found = further
        return found


class Region:
    """Sets of shingles as ranges of one array, and the links found among them."""

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.sizes = np.array([len(s) for s in sets])
        every, flat = np.unique(np.concatenate(sets), return_inverse=True)
        self.flat = flat.astype(np.int32)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.mark = np.zeros(len(every), bool)
        self.percent = percent
        self.links = Links(len(sets))

    def shared(self, pivot: int, points: np.ndarray) -> np.ndarray:
        """Size of the intersection of one set with each of some others."""
        own = self.flat[self.starts[pivot] : self.starts[pivot] + self.sizes[pivot]]
        self.mark[own] = True
        found = []
        for part in np.array_split(points, 1 + int(self.sizes[points].sum()) // 1_000_000):
            sizes = self.sizes[part]
            ends = np.cumsum(sizes)
            at = np.repeat(self.starts[part] - (ends - sizes), sizes) + np.arange(ends[-1])
            found.append(np.add.reduceat(self.mark[self.flat[at]], ends - sizes, dtype=np.int64))
        self.mark[own] = False
        return np.concatenate(found)

    def measure(self, pivot: int, points: np.ndarray) -> np.ndarray:
        """Distances to a pivot; what is within reach is linked to it."""
        shared = self.shared(pivot, points)
        union = self.sizes[pivot] + self.sizes[points] - shared
        for k in points[100 * shared >= self.percent * union]:
            self.links.join(pivot, int(k))
        return 1 - shared / union

    def apart(self, points: np.ndarray) -> bool:
        roots = self.links.roots(points)
        return bool((roots != roots[0]).any())

    def pairs(self, points: np.ndarray) -> None:
        """Every pair whose windows meet, unless it is connected or its sizes forbid a link."""
        wanted = np.zeros(len(self.sizes), bool)
        wanted[points] = True
        for p in points.tolist():
            wanted[p] = False
            spans = [self.owner[a:b] for a, b in self.spans[self.first[p] : self.first[p + 1]]]
            if not spans:
                continue
            others = np.unique(np.concatenate(spans))
            others = others[wanted[others]]
            size = self.sizes[others]
            near = 100 * np.minimum(size, self.sizes[p]) >= self.percent * np.maximum(
                size, self.sizes[p]
            )
            others = others[near]
            if len(others):
                others = others[self.links.roots(others) != self.links.find(p)]
            if len(others):
                self.measure(p, others)

    def met(self) -> list[np.ndarray]:
        """Points whose windows over all their shingles, the rarest first, meet."""
        often = np.bincount(self.flat)
        rank = np.empty(len(often), np.int64)
        rank[np.argsort(often, kind="stable")] = np.arange(len(often))
        owner = np.repeat(np.arange(len(self.sizes)), self.sizes)
        order = np.lexsort((rank[self.flat], owner))
        lacking = self.sizes - -(-self.sizes * self.percent // 100)
        inside = np.arange(len(order)) - self.starts[owner] <= lacking[owner]
        shingle, owner = self.flat[order[inside]], owner[inside]
        shared = often[shingle] > 1
        shingle, owner = shingle[shared], owner[shared]
        # per point, from its first on: where the points of each shingle of its window are
        order = np.argsort(shingle, kind="stable")
        by_shingle = shingle[order]
        self.owner = owner[order]
        self.spans = np.stack(
            [np.searchsorted(by_shingle, shingle, side) for side in ("left", "right")], 1
        )
        self.first = np.searchsorted(owner, np.arange(len(self.sizes) + 1))
        same = shingle[order[1:]] == shingle[order[:-1]]
        near = Links(len(self.sizes))
        for a, b in zip(owner[order[:-1]][same].tolist(), owner[order[1:]][same].tolist(), strict=True):
            near.join(a, b)
        roots = near.roots(np.arange(len(self.sizes)))
        order = np.argsort(roots, kind="stable")
        cuts = np.flatnonzero(np.diff(roots[order])) + 1
        return [g for g in np.split(order, cuts) if len(g) > 1]

    def join(self) -> None:
        """Voronoi regions with windows, recursively."""
        todo = self.met()
        while todo:
            points = todo.pop()
            if len(points) < 2 or not self.apart(points):
                continue
            if len(points) <= LEAF:
                self.pairs(points)
                continue
            step = len(points) / PIVOTS
            pivots = [int(points[int(k * step)]) for k in range(PIVOTS)]
            distances = np.stack([self.measure(p, points) for p in pivots], 1)
            if not self.apart(points):
                continue
            reach = distances.min(1) + 2 * (1 - self.percent / 100) + 1e-9
            windows = [points[distances[:, k] <= reach] for k in range(PIVOTS)]
            windows = list({w.tobytes(): w for w in windows}.values())
            sizes = [len(w) for w in windows]
            if 2 * sum(sizes) > 3 * len(points) or 3 * max(sizes) > 2 * len(points):
                self.pairs(points)  # pivots do not divide these
            else:
                todo += windows


_POINTS = ["doc_id", "shingles"]


def _linked(percent: int):
    """Per region of a partition sorted by region: each point and its root in the region."""

    def close(region, ids, sets):
        order = np.argsort(np.array(ids), kind="stable")
        ids = np.array(ids)[order]
        held = Region([sets[k] for k in order], percent)
        held.join()
        roots = held.links.roots(np.arange(len(ids)))
        columns = [pa.array(ids), pa.array(ids[roots])]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "root"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        region, ids, sets = None, [], []
        for batch in batches:
            columns = (batch.column(c) for c in ("region", *_POINTS))
            for r, ident, own in zip(*columns, strict=True):
                if r.as_py() != region and ids:
                    yield close(region, ids, sets)
                    ids, sets = [], []
                region = r.as_py()
                ids.append(ident.as_py())
                sets.append(own.values.to_numpy())
        if ids:
            yield close(region, ids, sets)

    return run


def _windows(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Per region and chunk, pivots first: the regions that each point goes to."""
    key, pivots = None, []
    for batch in batches:
        out: list[tuple[str, int]] = []
        columns = (batch.column(c) for c in ("region", "chunk", "is_pivot", *_POINTS))
        for r, c, is_pivot, ident, own in zip(*columns, strict=True):
            if (r.as_py(), c.as_py()) != key:
                key, pivots = (r.as_py(), c.as_py()), []
            own = own.values.to_numpy()
            if is_pivot.as_py():
                pivots.append((ident.as_py(), own))
                continue
            distances = []
            for _, pivot in pivots:
                shared = len(np.intersect1d(own, pivot, assume_unique=True))
                distances.append(1 - shared / (len(own) + len(pivot) - shared))
            reach = min(distances) + 2 * (1 - percent / 100) + 1e-9
            near = zip(pivots, distances, strict=True)
            out += [(f"{r.as_py()}/{p[0]}", ident.as_py()) for p, d in near if d <= reach]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r for r, _ in out], pa.string()), pa.array([d for _, d in out], pa.int64())],
            ["region", "doc_id"],
        )


def _divided(points: DataFrame, percent: int, limit: int, rounds: int = 4) -> DataFrame:
    """Regions that fit into a task, from points of regions that do not.

    Points that hang together only by common shingles are first told apart by windows over
    all their shingles. Then each round takes pivots by a hash of the id, in proportion to the
    region, and deals the points into the windows of the pivots. What the pivots do not divide
    is cut into blocks, and every pair of blocks is a region.
    """
    done, sets = None, points.select(*_POINTS)
    full = sets.select(
        "doc_id",
        F.size("shingles").alias("n"),
        F.col("shingles").alias("some"),
        F.lit(True).alias("whole"),
    )
    apart = _regions(full, percent, only_whole=True)
    sized = apart.join(full.select(F.col("doc_id").alias("node"), "n"), "node")
    here = staged(
        sized.select(F.col("root").cast("string").alias("region"), F.col("node").alias("doc_id"), "n"), "apart"
    )
    for _ in range(rounds):
        total = here.groupBy("region").agg(F.sum("n").alias("total"))
        sized = staged(here.join(total, "region"), "sized")
        fits = sized.where(F.col("total") <= limit).select("region", "doc_id")
        done = fits if done is None else done.unionByName(fits)
        large = sized.where(F.col("total") > limit)
        if not large.limit(1).count():
            return done
        order = F.xxhash64("doc_id", "region")
        share = F.least(F.lit(32), F.ceil(2 * F.col("total") / limit)) * F.col("n") / F.col("total")
        chosen = F.pmod(order, F.lit(1 << 20)) < F.greatest(share * (1 << 20), F.lit(1))
        firsts = large.groupBy("region").agg(F.min_by("doc_id", order).alias("doc_id"))
        pivots = large.where(chosen).select("region", "doc_id").union(firsts).distinct()
        chunk = F.pmod(F.xxhash64("doc_id"), F.ceil(4 * F.col("total") / limit))
        dealt = large.withColumn("chunk", chunk).join(sets, "doc_id").withColumn("is_pivot", F.lit(False))
        chunks = dealt.select("region", "chunk").distinct()
        copies = pivots.join(sets, "doc_id").join(chunks, "region").withColumn("is_pivot", F.lit(True))
        columns = ["region", "chunk", "is_pivot", *_POINTS]
        both = dealt.select(columns).unionByName(copies.select(columns))
        both = both.repartition("region", "chunk").sortWithinPartitions(
            "region", "chunk", F.desc("is_pivot")
        )
        moved = both.mapInArrow(lambda b: _windows(b, percent), "region string, doc_id bigint")
        size_of = sets.select("doc_id", F.size("shingles").alias("n"))
        moved = staged(moved.join(size_of, "doc_id"), "moved")
        here = large.select("region", "doc_id", "n")
        if moved.count() >= 3 * here.count():
            break  # pivots do not divide these
        here = moved
    total = here.groupBy("region").agg(F.sum("n").alias("total"))
    sized = here.join(total, "region")
    fits = sized.where(F.col("total") <= limit).select("region", "doc_id")
    blocks = F.ceil(4 * F.col("total") / limit)
    own = F.pmod(F.xxhash64("doc_id"), blocks)
    pair = F.explode(
        F.transform(
            F.sequence(F.lit(0).cast("bigint"), blocks - 1),
            lambda b: F.concat_ws("-", F.col("region"), F.least(b, own), F.greatest(b, own)),
        )
    )
    paired = sized.where(F.col("total") > limit).select(pair.alias("region"), "doc_id")
    return done.unionByName(fits).unionByName(paired)


def _regions(classes: DataFrame, percent: int, only_whole: bool = False) -> DataFrame:
    """``node`` and ``root`` of the points whose windows over shingle pivots meet."""
    below = _below(percent)
    lacking = F.col("n") - F.ceil(F.col("n") * percent / 100)
    pivots = F.filter("some", lambda h: h < below)
    levels = [
        F.struct(F.lit(0).alias("level"), pivots.alias("own")),
        F.struct(F.lit(1).alias("level"), F.when(F.col("whole"), F.col("some")).alias("own")),
    ]
    levels = F.array(*(levels[1:] if only_whole else levels))
    # Partners differ in size by the share at most, so a point meets them in its own ring of
    # sizes, or in the next one that the largest of them can be in.
    width = RING * math.log(100 / percent) if percent < 100 else RING
    ring = F.sequence(
        F.floor(F.log("n") / width), F.floor((F.log(F.col("n") * 100 / percent) + 1e-9) / width)
    )
    rows = (
        classes.select("doc_id", lacking.alias("lacking"), ring.alias("rings"), F.explode(levels).alias("l"))
        .where(F.size("l.own") > 0)
        .select("doc_id", "lacking", F.explode("rings").alias("ring"), "l")
    )
    # One number names level, ring and shingle; should two meet in it, regions get larger.
    rows = rows.select(
        "doc_id",
        (F.col("lacking") + 1 - F.size("l.own")).alias("spare"),
        (F.col("ring") * 2 + F.col("l.level")).cast("int").alias("round"),
        F.explode("l.own").alias("pivot"),
    ).withColumn("key", F.xxhash64("round", "pivot")).drop("pivot")
    often = rows.groupBy("key").agg(F.count("*").alias("df")).where("df > 1")
    # Pivots of no one else come first in every window, so only their number matters.
    ranked = (
        rows.join(often, "key")
        .groupBy("doc_id", "round", "spare")
        .agg(F.sort_array(F.collect_list(F.struct("df", "key"))).alias("shared"))
        .withColumn("window", F.col("spare") + F.size("shared"))
        .where("window > 0")
    )
    window = F.slice("shared", F.lit(1), F.col("window").cast("int"))
    members = ranked.select(F.col("doc_id").alias("node"), F.explode(window).alias("p")).select(
        "node", F.col("p.key").alias("key")
    )
    members = staged(members, "windows")
    several = members.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    return components(staged(members.join(several, "key"), "members"))


def jaccard_join(
    docs: DataFrame, percent: int = PERCENT, width: int = WIDTH, limit: int = TASK_ELEMENTS
) -> DataFrame:
    """``doc_id``, size of its set and its component, one row per document.

    ``percent`` has to be over 5, so that the pivots are not more than all shingles.
    """
    every = shingles(F.col("text"), width)
    below = _below(percent)
    lacking = F.size("every") - F.ceil(F.size("every") * percent / 100)
    few = F.size("pivots") <= lacking
    points = (
        docs.select("doc_id", every.alias("every"))
        .withColumn("pivots", F.filter("every", lambda h: h < below))
        .select(
            "doc_id",
            F.size("every").cast("bigint").alias("n"),
            F.xxhash64("every").alias("code"),
            F.xxhash64(F.lit(1), "every").alias("code2"),
            few.alias("whole"),
            F.when(few, F.col("every")).otherwise(F.col("pivots")).alias("some"),
        )
    )
    points = staged(points, "points")
    same = ["n", "code", "code2"]
    classes = (
        points.where("n > 0 and doc_id is not null")
        .groupBy(*same, "whole")
        .agg(F.min(F.struct("doc_id", "some")).alias("least"))
        .select("least.doc_id", "least.some", "n", "code", "code2", "whole")
    )
    regions = _regions(classes, percent)
    total = docs.where("doc_id is not null").select(F.col("doc_id").alias("node"), "text")
    met = (
        # Texts meet their regions without a copy of the regions in the driver, however few.
        total.join(regions.hint("merge"), "node")
        .select(
            F.col("root").cast("string").alias("region"),
            F.col("node").alias("doc_id"),
            shingles(F.col("text"), width).alias("shingles"),
        )
        .dropDuplicates(["doc_id"])
    )
    sizes = points.select("doc_id", "n").dropDuplicates(["doc_id"])
    large = (
        regions.join(sizes, regions["node"] == sizes["doc_id"])
        .groupBy(F.col("root").cast("string").alias("region"))
        .agg(F.sum("n").alias("total"))
        .where(F.col("total") > limit)
        .select("region")
    )
    large = staged(large, "large")
    divided = bool(large.limit(1).count())
    if divided:
        met = staged(met, "regions")
        again = _divided(met.join(large, "region", "left_semi"), percent, limit)
        sets = met.select(*_POINTS)
        met = met.join(large, "region", "left_anti").unionByName(
            again.join(sets, "doc_id").select("region", *_POINTS)
        )
    dealt = met.repartition("region").sortWithinPartitions("region")
    linked = staged(dealt.mapInArrow(_linked(percent), "doc_id bigint, root bigint"), "linked")
    if divided:
        links = linked.where("doc_id != root")
        ends = F.explode(F.array("doc_id", "root"))
        members = links.select(F.col("root").alias("key"), ends.alias("node")).distinct()
        linked = components(staged(members, "links")).select(F.col("node").alias("doc_id"), "root")
    roots = linked.where("doc_id != root").withColumnRenamed("doc_id", "least")
    classed = points.where("n > 0 and doc_id is not null").groupBy(*same).agg(F.min("doc_id").alias("least"))
    classed = classed.join(roots, "least", "left").select(*same, F.coalesce("root", "least").alias("root"))
    return points.join(classed, same, "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id")).alias("component_id"),
    )
