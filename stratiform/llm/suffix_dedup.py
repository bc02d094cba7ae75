"""Repeated passages by external induced sorting of suffixes.

A byte goes if a string of ``length`` bytes that covers it also starts anywhere else. The
order of suffixes is never built for the whole table, only for the places that can matter:

1. Seeds. In every string of ``length`` bytes the place with the least hash among its first
   (all but the last ``CONTEXT`` - 1) is its seed, so equal strings have their seed at the same offset. The
   ``CONTEXT`` bytes from the seed name it. A name that occurs once rules out all strings
   with this seed. All bytes that the strings of a seed cover are its variant, known by a
   fingerprint. Names, variants and places alone are counted, with partial aggregation: a
   passage that a third of all texts share is one row per task. A variant that occurs
   again is repeated as a whole, and only one of it goes on.
2. Shards. Where a name has several variants, their bytes are cut out and dealt and sorted
   by name. The sorted shuffle is the queue on disk: it spills, merges, and hands the suffix
   tuples to a task in order, so a shard is read in chunks of bounded size, each with whole
   names.
3. Induction. In a chunk the suffixes at the seeds are sorted, with the length of the
   prefix each has in common with the one before. The suffixes one byte further left
   follow from them: walked in order, they fall into buckets by their new first byte, and
   keep their order there; common prefixes are one longer than the least one in between.
   So it goes on, byte by byte. A string is repeated where a neighbour has ``length`` bytes in common.
4. A name with more than ``HOT`` variants would be a group without a bound. Its strings
   are counted by 128-bit fingerprints instead, with partial aggregation.

Texts go by two hashes, of 96 bits together, and their length: a text that occurs
more than once goes whole if it has ``length`` bytes, and takes part once. Null is an
empty text; shorter texts than ``length`` stay whole. Repeated rows are copies. Other columns
are not read. An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiform.llm.common import staged

LENGTH = 400
CONTEXT = 61
HOT = 40_000
CHUNK_BYTES = 6 * 1024**2
SLICE_BYTES = 512 * 1024
_GRAM = 8
_ODD = np.uint64(0x9E3779B97F4A7C15)
_ODD2 = np.uint64(0xC2B2AE3D27D4EB4F)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * _ODD
    return x ^ (x >> np.uint64(32))


def seeds(
    data: np.ndarray, cuts: np.ndarray, length: int = LENGTH
) -> tuple[np.ndarray, ...]:
    """Seeds of texts that follow one another: text, place, first and last string, name.

    ``cuts`` are the ends of the texts and 0. Places count from the start of the text; first
    and last are the starts of the strings that have this seed.
    """
    n, window = len(data), length - CONTEXT + 1
    none = (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),)
    if n < length:
        return none
    padded = np.concatenate([data, np.zeros(_GRAM, np.uint8)])
    grams = np.ndarray((n,), "<u8", padded.data, strides=(1,)).copy()
    value = _mixed(grams)
    # least value, and of equal ones the last place
    place = np.arange(n, dtype=np.uint64)
    low = np.uint64((1 << 24) - 1)
    keyed = (value & ~low) | (low - (place & low))
    blocks = -(-n // window)
    tiles = np.full(blocks * window, np.uint64(0xFFFFFFFFFFFFFFFF))
    tiles[:n] = keyed
    tiles = tiles.reshape(blocks, window)
    ahead = np.minimum.accumulate(tiles, 1).ravel()
    back = np.minimum.accumulate(tiles[:, ::-1], 1)[:, ::-1].ravel()
    starts = n - length + 1
    least = np.minimum(back[:starts], ahead[window - 1 : window - 1 + starts])
    seed = (low - (least & low)).astype(np.int64)
    text = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))[:starts]
    valid = np.arange(starts) + length <= cuts[text + 1]
    (at,) = valid.nonzero()
    if not len(at):
        return none
    seed, text = seed[at], text[at]
    first = np.flatnonzero(np.r_[True, (seed[1:] != seed[:-1]) | (text[1:] != text[:-1])])
    last = np.r_[first[1:], len(at)] - 1
    place, owner = seed[first], text[first]
    name = np.zeros(len(first), np.uint64)
    for k in [*range(0, CONTEXT - _GRAM, _GRAM), CONTEXT - _GRAM]:
        name = _mixed((name ^ value[place + k]) + _ODD2)
    base = cuts[owner]
    return owner, place - base, at[first] - base, at[last] - base, name


def _each(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The contents of a batch in slices of some size: first row, bytes, ends of texts."""
    contents = batch.column("content").to_pylist()
    start = 0
    while start < len(contents):
        stop, size = start, 0
        while stop < len(contents) and (stop == start or size + len(contents[stop]) <= SLICE_BYTES):
            size += len(contents[stop])
            stop += 1
        part = contents[start:stop]
        cuts = np.cumsum([0, *map(len, part)])
        yield start, np.frombuffer(b"".join(part), np.uint8), cuts
        start = stop


_SEEDS = (
    "key bigint, f1 bigint, c1 bigint, c2 int, place bigint, first bigint, last bigint"
)


def _seeds_of(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        c1, c2 = (batch.column(c).to_numpy() for c in ("c1", "c2"))
        for start, data, cuts in _each(batch):
            some = _long_seeds if len(data) >= 1 << 24 else seeds
            found = some(data, cuts, length)
            owner, place, first, last, name = found
            rows = owner + start
            raw, base = data.tobytes(), cuts[owner]
            prints = _digests(raw, base + first, base + last + length, place - first)
            columns = (name.view(np.int64), prints, c1[rows], c2[rows], place, first, last)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in columns], [c.split()[0] for c in _SEEDS.split(", ")]
            )


def _digests(raw: bytes, starts: np.ndarray, stops: np.ndarray, left: np.ndarray):
    """Fingerprints of ranges of bytes and of where in them the seed is."""
    code = hashlib.blake2b
    each = zip(starts.tolist(), stops.tolist(), left.tolist(), strict=True)
    joined = b"".join(
        [code(raw[a:b], digest_size=8, salt=n.to_bytes(8, "little")).digest() for a, b, n in each]
    )
    return np.frombuffer(joined, "<i8")


def _long_seeds(
    data: np.ndarray, cuts: np.ndarray, length: int = LENGTH
) -> tuple[np.ndarray, ...]:
    """The same for one text of any length, in parts that overlap by a string."""
    step, parts = 1 << 22, []
    for start in range(0, max(len(data) - length + 1, 1), step):
        part = data[start : start + step + length - 1]
        owner, place, first, last, name = seeds(part, np.array([0, len(part)]), length)
        parts.append((owner, place + start, first + start, last + start, name))
    return tuple(np.concatenate(c) for c in zip(*parts, strict=True))


class Chunk:
    """Seeds with the bytes around them, whole names, in order of name."""

    def __init__(self, rows: list[tuple[int, int, int, bytes]], length: int):
        """Rows: number of the name, offset of the seed in its bytes, strings, bytes."""
        self.length = length
        self.group = np.array([r[0] for r in rows])
        self.left = np.array([r[1] for r in rows])
        self.strings = np.array([r[2] for r in rows])
        sizes = np.array([len(r[3]) for r in rows])
        self.flat = np.frombuffer(b"".join(r[3] for r in rows), np.uint8)
        self.start = np.cumsum(sizes) - sizes
        self.right = sizes - self.left

    def _sorted_seeds(self) -> tuple[np.ndarray, np.ndarray]:
        """Order of the suffixes at the seeds, and the prefix each shares with the one before."""
        width = self.length
        reach = np.minimum(np.arange(width), self.right[:, None] - 1)
        rows = self.flat[(self.start + self.left)[:, None] + reach]
        rows[np.arange(width) >= self.right[:, None]] = 0
        by_length = np.argsort(self.right, kind="stable")
        texts = np.ascontiguousarray(rows[by_length]).view(f"S{width}").ravel()
        order = by_length[np.argsort(texts, kind="stable")]
        order = order[np.argsort(self.group[order], kind="stable")]
        common = np.zeros(len(order), np.int64)
        differs = rows[order[1:]] != rows[order[:-1]]
        same = np.where(differs.any(1), differs.argmax(1), width)
        both = np.minimum(self.right[order[1:]], self.right[order[:-1]])
        common[1:] = np.minimum(same, both) * (self.group[order[1:]] == self.group[order[:-1]])
        return order, common

    def repeated(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, first and last of each run of repeated strings, as distances left of the seed."""
        order, common = self._sorted_seeds()
        steps = int(self.left.max()) + 1
        hit = np.zeros((len(self.left), steps + 1), bool)
        for offset in range(steps):
            if offset:
                order, common = self._induced(order, common, offset)
            if not len(order):
                break
            long_ = common >= self.length
            either = long_ | np.r_[long_[1:], False]
            hit[order[either], offset] = True
        # strings of another seed are judged there
        distance = np.arange(steps + 1)
        own = (distance <= self.left[:, None]) & (distance > (self.left - self.strings)[:, None])
        edge = np.diff((hit & own).astype(np.int8), axis=1, prepend=0)
        row, first = (edge == 1).nonzero()
        _, stop = (edge == -1).nonzero()
        return row, first, stop - 1

    def _induced(self, order: np.ndarray, common: np.ndarray, offset: int):
        """The suffixes one byte to the left, from those in order."""
        (here,) = (self.left[order] >= offset).nonzero()
        rows = order[here]
        byte = self.flat[self.start[rows] + self.left[rows] - offset]
        bucket = np.argsort(byte, kind="stable")
        rank, rows = here[bucket], rows[bucket]
        longer = np.zeros(len(rows), np.int64)
        if len(rows) > 1:
            byte, group = byte[bucket], self.group[rows]
            low, high = rank[:-1] + 1, rank[1:] + 1
            (near,) = ((byte[1:] == byte[:-1]) & (group[1:] == group[:-1])).nonzero()
            low, high = low[near], high[near]
            least = common[high - 1]
            (far,) = (high - low > 1).nonzero()
            if len(far):
                ends = np.stack([low[far], high[far]], 1).ravel()
                closed = np.append(common, 0)
                least[far] = np.minimum.reduceat(closed, ends)[::2]
            longer[near + 1] = least + 1
        return rows, longer


_RUNS = "c1 bigint, c2 int, start bigint, stop bigint"


def _cut_out(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """The bytes that the strings of each seed cover, and what follows it."""
    names = ["key", "c1", "c2", "place", "first", "last", "bytes"]
    for batch in batches:
        rows, size = [], 0
        columns = (batch.column(c) for c in ("c1", "c2", "content", "seeds"))
        for c1, c2, content, own in zip(*columns, strict=True):
            text = content.as_py()
            for s in own.as_py():
                part = text[s["first"] : s["last"] + length]
                size += len(part)
                rows.append((s["key"], c1.as_py(), c2.as_py(), s["place"], s["first"], s["last"], part))
            if size > SLICE_BYTES:
                yield _rows(rows, names)
                rows, size = [], 0
        if rows:
            yield _rows(rows, names)


def _rows(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    kinds = [pa.int32() if n == "c2" else pa.int64() for n in names[:-1]]
    arrays = [pa.array(c, k) for c, k in zip(columns, [*kinds, pa.binary()], strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names)


def _induce(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Runs of repeated strings, from seeds sorted by name."""
    rows: list[tuple] = []
    size, last_key = 0, None

    def done():
        places = {key: k for k, key in enumerate(dict.fromkeys(r[0] for r in rows))}
        chunk = Chunk([(places[r[0]], r[3] - r[4], r[5] - r[4] + 1, r[6]) for r in rows], length)
        row, first, last = chunk.repeated()
        codes = np.array([r[1:4] for r in rows], np.int64).reshape(-1, 3)
        c1, c2, place = codes[row].T
        columns = (c1, c2, place - last, place - first + length)
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            ["c1", "c2", "start", "stop"],
        )

    for batch in batches:
        names = ("key", "c1", "c2", "place", "first", "last", "bytes")
        for row in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
            if size > CHUNK_BYTES and row[0] != last_key:
                yield done()
                rows, size = [], 0
            last_key = row[0]
            rows.append(row)
            size += len(row[6]) + 400
    if rows:
        yield done()


def _fingerprints(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Two hashes of each string of seeds with a hot name."""
    for batch in batches:
        names = ("c1", "c2", "first", "last", "bytes")
        out: list[tuple] = []
        for c1, c2, first, last, part in zip(
            *(batch.column(c).to_pylist() for c in names), strict=True
        ):
            for k in range(last - first + 1):
                code = hashlib.blake2b(part[k : k + length], digest_size=16).digest()
                h1 = int.from_bytes(code[:8], signed=True)
                out.append((h1, int.from_bytes(code[8:], signed=True), c1, c2, first + k))
        columns = zip(*out, strict=True) if out else [()] * 5
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            ["h1", "h2", "c1", "c2", "start"],
        )


_RESULT = (
    "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept_text string"
)


def _kept(with_text: bool, carried: bool, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, spans, codes, texts = [], [], [], []
            columns = (batch.column(c) for c in ("content", "copied", "runs"))
            for content, copied, runs in zip(*columns, strict=True):
                text = content.as_py()
                whole = copied.as_py() and len(text) >= length
                found = [(0, len(text))] if whole else []
                for run_ in [] if whole else runs.as_py() or ():
                    start, stop = run_["start"], run_["stop"]
                    if found and start <= found[-1][1]:
                        found[-1] = (found[-1][0], max(stop, found[-1][1]))
                    else:
                        found.append((start, stop))
                edges = [0, *(e for span in found for e in span), len(text)]
                kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                removed.append(len(text) - len(kept))
                spans.append(len(found))
                codes.append(hashlib.sha256(kept).hexdigest())
                texts.append(kept.decode("utf-8", "ignore") if with_text else None)
            out = {
                "doc_id": batch.column("doc_id"),
                "n_bytes": batch.column("n_bytes"),
                "n_removed": pa.array(removed, pa.int64()),
                "n_spans": pa.array(spans, pa.int64()),
                "kept_sha256": pa.array(codes, pa.string()),
                "kept_text": pa.array(texts, pa.string()),
            }
            if carried:
                out["carried"] = batch.column("carried")
            yield pa.RecordBatch.from_pydict(out)

    return run


def suffix_dedup(
    docs: DataFrame,
    hot: int = HOT,
    with_text: bool = False,
    carry: tuple[str, ...] = (),
    length: int = LENGTH,
) -> DataFrame:
    """Sizes, removed bytes, spans and digest of what is kept, and with ``with_text`` that itself,
    as text without characters that were cut in two.

    Columns named in ``carry`` come back as the struct ``carried``. ``length`` is the number of
    bytes from which a repetition counts, more than ``CONTEXT``.
    """
    if length <= CONTEXT:
        raise ValueError(f"length {length}: strings are told apart by {CONTEXT} bytes")
    text = F.coalesce("text", F.lit(""))
    extra = [F.struct(*carry).alias("carried")] if carry else []
    coded = docs.select(
        "doc_id",
        text.cast("binary").alias("content"),
        F.octet_length(text).cast("bigint").alias("n_bytes"),
        F.xxhash64(text).alias("c1"),
        F.hash(text).alias("c2"),
        *extra,
    )
    schema = _RESULT + (f", carried {coded.schema['carried'].dataType.simpleString()}" if carry else "")
    code = ["c1", "c2"]
    whole = [*code, "n_bytes"]
    owners = coded.groupBy(*whole).agg(
        F.count("*").alias("copies"), F.min("doc_id").alias("owner")
    )
    owners = staged(owners, "owners")
    long_ = coded.where(F.col("n_bytes") >= length)
    found = long_.select("content", *code).mapInArrow(partial(_seeds_of, length=length), _SEEDS)
    names = found.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    found = staged(found.join(names, "key"), "seeds")
    where = [*code, "place", "first", "last"]
    variant = ["key", "f1"]
    # Any seed of a variant will do for it: their bytes are the same.
    variants = found.groupBy(*variant).agg(
        F.count("*").alias("n"), *[F.first(c).alias(c) for c in where]
    )
    variants = staged(variants, "variants")
    several = variants.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    several = staged(several.select("key", (F.col("n") > hot).alias("hot")), "names")
    twice = variants.where("n > 1").select(*variant)
    runs = found.join(twice, variant).select(
        *code, F.col("first").alias("start"), (F.col("last") + length).alias("stop")
    )
    again = variants.select("key", *where).join(several, "key")
    seed = F.struct("key", "place", "first", "last", "hot")
    by_text = again.groupBy(*code).agg(F.collect_list(seed).alias("seeds")).join(owners, code)
    # The texts are shuffled once: this join and the last one deal them in the same way.
    texts = coded.join(by_text, whole).where(coded["doc_id"].eqNullSafe(F.col("owner")))
    texts = texts.select(*coded.columns, "seeds")
    parts = "key bigint, c1 bigint, c2 int, place bigint, first bigint, last bigint, bytes binary"

    def cut(some):
        own = F.filter("seeds", some)
        return texts.withColumn("seeds", own).where(F.size("seeds") > 0).mapInArrow(
            partial(_cut_out, length=length), parts
        )

    dealt = cut(lambda s: ~s["hot"]).repartition("key").sortWithinPartitions("key")
    runs = runs.unionByName(dealt.mapInArrow(partial(_induce, length=length), _RUNS))
    if several.where("hot").limit(1).count():
        prints = cut(lambda s: s["hot"]).mapInArrow(
            partial(_fingerprints, length=length), "h1 bigint, h2 bigint, c1 bigint, c2 int, start bigint"
        )
        prints = staged(prints, "fingerprints")
        twice = prints.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1")
        single = prints.join(twice, ["h1", "h2"]).select(
            *code, "start", (F.col("start") + length).alias("stop")
        )
        runs = runs.unionByName(single)
    spans = runs.groupBy(*code).agg(
        F.sort_array(F.collect_set(F.struct("start", "stop"))).alias("runs")
    )
    known = owners.select(*whole, (F.col("copies") > 1).alias("copied")).join(
        spans, code, "left"
    )
    known = known.where(F.col("copied") | F.col("runs").isNotNull())
    return (
        coded.join(known, whole, "left")
        .select("doc_id", "content", "n_bytes", "copied", "runs", *(["carried"] if carry else []))
        .mapInArrow(_kept(with_text, bool(carry), length), schema)
    )
