"""Phrases of two and three words that occur together more than their parts explain.

Texts are lower-cased (A-Z), split at ``BREAKS`` into pieces and these at blanks into words.
Per language, a phrase of at least ``least`` occurrences is a candidate. Cut after its first
words, its score is floor(1000000 a a / (l r)) of the occurrences of the whole and both parts;
the lowest-scoring cut counts, the shortest first part of equals. A candidate inside a longer
one with at least ``inside`` percent of its occurrences goes. The ``top`` best of each language
are the result.

Phrases grow from prefixes, the best first. A prefix that occurs p times and whose first word
occurs l times cannot grow to a phrase of a higher score than floor(1000000 p / l): no
extension occurs more often than the prefix, nor its rest less often than itself. So each
round sets a threshold per language, grows the prefixes whose bound reaches it, and settles
the pairs whose score does, which takes the longer phrases around them, whatever their score.
A language is done when ``top`` survivors reach the threshold: all that score as much, ties
included, are then known. Otherwise the threshold falls to the score of twice as many pairs. A language
whose pairs are used up has grown all its prefixes and is done, too.

Each round is one pass over the texts. What may be counted in it is told to the tasks by bit
tables of fixed size (``BITS``, two bits per phrase); a false positive costs rows, never a
result, since it is counted like any phrase and the joins that follow are exact.

Null texts count as empty, null languages as ``und``. Repeated rows count each time. Other
columns are ignored, whatever their names. Empty tables give empty results. Long texts are
counted in parts cut at breaks.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratiform.llm.common import staged

TOP, LEAST, INSIDE = 2000, 10, 50
SCALE = 1_000_000
BITS = 1 << 26
PART_BYTES = 1 << 21
ROWS = 20_000  # counts sent from a task at a time
SALTS = 64

# What ends a piece.
BREAKS = b".,;:!?\n\x0b\x0c\r"
_CAPITALS = bytes(range(65, 91))
_TABLE = bytes.maketrans(
    _CAPITALS + BREAKS + b"\t", _CAPITALS.lower() + b"\n" * len(BREAKS) + b" "
)
_BREAK = b"\xff"  # no byte of UTF-8 text


# --- words in tasks ----------------------------------------------------------


def _parts(batches) -> Iterator[tuple[str, bytes]]:
    """Texts of one language together, split at breaks, in parts of bounded size."""
    waiting, size = defaultdict(list), 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            data = text.as_buffer().to_pybytes().translate(_TABLE)
            while len(data) > PART_BYTES:
                cut = data.find(b"\n", PART_BYTES)
                if cut < 0:
                    break
                yield lang, data[:cut]
                data = data[cut + 1 :]
            waiting[lang].append(data)
            size += len(data)
            if size > PART_BYTES:
                yield from ((k, b"\n".join(v)) for k, v in waiting.items())
                waiting, size = defaultdict(list), 0
    yield from ((k, b"\n".join(v)) for k, v in waiting.items())


def _coded(data: bytes) -> tuple[np.ndarray, list[bytes]]:
    """The words of a part as numbers, 0 for a break, and the words by number."""
    codes: dict[bytes, int] = defaultdict()
    codes.default_factory = codes.__len__
    codes[_BREAK]
    words = data.replace(b"\n", b" \xff ").split()
    numbers = np.fromiter(map(codes.__getitem__, words), np.int64, len(words))
    codes.default_factory = None  # it holds the table, which would wait for the collector
    return numbers, list(codes)


def _hashes(lang: str, words: list[bytes]) -> np.ndarray:
    seed = xxhash.xxh64_intdigest(lang.encode())
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))


def _pair_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    mixed = first * np.uint64(0x9E3779B97F4A7C15) + (second ^ (second >> np.uint64(31)))
    mixed *= np.uint64(0xC2B2AE3D27D4EB4F)
    return mixed ^ (mixed >> np.uint64(29))


def _places(hashes: np.ndarray) -> np.ndarray:
    mask = np.uint64(BITS - 1)
    return np.concatenate([hashes & mask, (hashes >> np.uint64(32)) & mask]).astype(np.int64)


class Bits:
    """A table of bits of fixed size that says of a hash: maybe one of them, or surely not."""

    def __init__(self, phrases: DataFrame):
        def cells(batches):
            for batch in batches:
                if not batch.num_rows:
                    continue
                columns = [c.to_pylist() for c in batch.columns]
                by_lang = defaultdict(list)
                for lang, *words in zip(*columns):
                    by_lang[lang].append(words)
                for lang, found in by_lang.items():
                    hashes = [_hashes(lang, [w.encode() for w in ws]) for ws in zip(*found)]
                    places = _places(hashes[0] if len(hashes) == 1 else _pair_hashes(*hashes))
                    bits = np.left_shift(np.int64(1), places & 63)
                    yield pa.record_batch({"cell": places >> 6, "bits": bits})

        found = phrases.mapInArrow(cells, "cell bigint, bits bigint")
        table = found.groupBy("cell").agg(F.bit_or("bits").alias("bits")).toArrow()
        cells = np.zeros(BITS >> 6, np.int64)
        cells[table["cell"].to_numpy()] = table["bits"].to_numpy()
        self.shared = phrases.sparkSession.sparkContext.broadcast(cells)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        places = _places(hashes)
        bits = (self.shared.value[places >> 6] >> (places & 63)) & 1
        return (bits[: len(hashes)] & bits[len(hashes) :]).astype(bool)


def _emit(lang: str, words: list[bytes], numbers: list[np.ndarray], counts: np.ndarray):
    """Rows of one language: the words by number, and counts."""
    names = pa.array(words, pa.binary())
    columns = {"lang": pa.array([lang]).take(pa.array(np.zeros(len(counts), np.int64)))}
    for k, number in enumerate(numbers):
        used, where = np.unique(number, return_inverse=True)
        texts = names.take(pa.array(used)).cast(pa.string())
        columns[f"w{k + 1}"] = texts.take(pa.array(where))
    columns["a"] = pa.array(counts.astype(np.int64))
    rows = pa.record_batch(columns)
    for start in range(0, rows.num_rows, ROWS):
        yield rows.slice(start, ROWS)


def _count_words(batches):
    for lang, data in _parts(batches):
        codes, words = _coded(data)
        counts = np.bincount(codes, minlength=len(words))
        counts[0] = 0
        seen = np.flatnonzero(counts)
        if len(seen):
            yield from _emit(lang, words, [seen], counts[seen])
            total = pa.array([int(counts.sum())])
            yield pa.record_batch({"lang": [lang], "w1": pa.nulls(1, pa.string()), "a": total})


def _known(lang: str, data: bytes, words_bits: Bits):
    """The words of a part with all that are too rare taken for breaks, and pairs of them."""
    codes, words = _coded(data)
    hashes = _hashes(lang, words)
    frequent = words_bits.has(hashes)
    frequent[0] = False
    codes = np.where(frequent[codes], codes, 0)
    starts = np.flatnonzero((codes[:-1] > 0) & (codes[1:] > 0))
    return codes, words, hashes, starts, codes[starts] * len(words) + codes[starts + 1]


def _count_pairs(words_bits: Bits):
    def count(batches):
        for lang, data in _parts(batches):
            _, words, _, _, keys = _known(lang, data, words_bits)
            pairs, counts = np.unique(keys, return_counts=True)
            if len(pairs):
                yield from _emit(lang, words, [pairs // len(words), pairs % len(words)], counts)

    return count


def _count_triples(words_bits: Bits, pairs_bits: Bits, grown_bits: Bits, settled_bits: Bits):
    def count(batches):
        for lang, data in _parts(batches):
            codes, words, hashes, starts, keys = _known(lang, data, words_bits)
            if not len(starts):
                continue
            size = len(words)
            pairs, where = np.unique(keys, return_inverse=True)
            mixed = _pair_hashes(hashes[pairs // size], hashes[pairs % size])
            frequent, settled = pairs_bits.has(mixed), settled_bits.has(mixed)
            grown = grown_bits.has(mixed) | settled
            next_to = np.flatnonzero(np.diff(starts) == 1)
            first, second = where[next_to], where[next_to + 1]
            wanted = frequent[first] & frequent[second] & (grown[first] | settled[second])
            first, third = first[wanted], codes[starts[next_to[wanted]] + 2]
            triples, counts = np.unique(first * size + third, return_counts=True)
            if len(triples):
                pair, last = pairs[triples // size], triples % size
                yield from _emit(lang, words, [pair // size, pair % size, last], counts)

    return count


# --- scores and rounds -------------------------------------------------------


def _counted(texts: DataFrame, step, width: int, least: int) -> DataFrame:
    words = [f"w{k + 1}" for k in range(width)]
    schema = ", ".join(["lang string", *[f"{w} string" for w in words], "a bigint"])
    counts = texts.mapInArrow(step, schema).groupBy("lang", *words).agg(F.sum("a").alias("a"))
    return counts.where((F.col("a") >= least) | F.col("w1").isNull())


def _score(a: str, left: str, right: str) -> Column:
    """floor(SCALE a a / (left right)), exact: the product of three counts passes 64 bits."""
    wide = {c: f"cast({c} as decimal(15, 0))" for c in (a, left, right)}
    product = f"cast({SCALE} as decimal(7, 0)) * ({wide[a]} * {wide[a]})"
    return F.expr(f"({product}) div ({wide[left]} * {wide[right]})")


def _pairs(counts: DataFrame, words: DataFrame) -> DataFrame:
    """Pairs with the occurrences of both words, their score, and the bound of what they grow to."""
    left = words.select("lang", "w1", F.col("a").alias("l"))
    right = words.select("lang", F.col("w1").alias("w2"), F.col("a").alias("r"))
    found = counts.join(left, ["lang", "w1"]).join(right, ["lang", "w2"])
    bound = F.expr(f"(cast({SCALE} as decimal(7, 0)) * cast(a as decimal(15, 0))) div cast(l as decimal(15, 0))")
    return found.select("lang", "w1", "w2", "a", "l", "r", _score("a", "l", "r").alias("score"), bound.alias("bound"))


def _scored(counts: DataFrame, pairs: DataFrame) -> DataFrame:
    """Triples with the parts of the lower-scoring cut, after the first word of equals."""
    head = pairs.select("lang", "w1", "w2", F.col("l").alias("x"), F.col("a").alias("xy"))
    tail = pairs.select(
        "lang", F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("yz"), F.col("r").alias("z")
    )
    both = counts.join(head, ["lang", "w1", "w2"]).join(tail, ["lang", "w2", "w3"])
    both = both.withColumns({"one": _score("a", "x", "yz"), "two": _score("a", "xy", "z")})
    early = F.col("one") <= F.col("two")
    return both.select(
        "lang",
        "w1",
        "w2",
        "w3",
        "a",
        F.when(early, F.col("x")).otherwise(F.col("xy")).alias("l"),
        F.when(early, F.col("yz")).otherwise(F.col("z")).alias("r"),
        F.least("one", "two").alias("score"),
    )


def _thresholds(pairs: DataFrame, rank: int) -> DataFrame:
    """By language, the score of the pair of this rank; 0 where there are fewer.

    At most ``SCALE`` + 1 scores of a language are sorted.
    """
    falling = Window.partitionBy("lang").orderBy(F.desc("score"))
    scores = pairs.groupBy("lang", "score").count().withColumn("upto", F.sum("count").over(falling))
    reached = F.max(F.when(F.col("upto") >= rank, F.col("score")))
    return scores.groupBy("lang").agg(F.coalesce(reached, F.lit(0)).alias("least"))


def _survivors(pairs: DataFrame, triples: DataFrame, inside: int) -> DataFrame:
    """Phrases that no longer one covers, as far as longer ones are known."""
    around = triples.select("lang", "w1", "w2", "a").unionAll(triples.select("lang", "w2", "w3", "a"))
    around = around.groupBy("lang", "w1", "w2").agg(F.max("a").alias("longer"))
    covered = F.col("longer") * 100 >= F.col("a") * inside
    single = pairs.join(around, ["lang", "w1", "w2"], "left").where(
        F.col("longer").isNull() | ~covered
    )
    columns = ["lang", "phrase", "a", "l", "r", "score"]
    return (
        single.withColumn("phrase", F.concat_ws(" ", "w1", "w2")).select(columns)
        .unionAll(triples.withColumn("phrase", F.concat_ws(" ", "w1", "w2", "w3")).select(columns))
    )


def mine(docs: DataFrame, top: int = TOP, least: int = LEAST, inside: int = INSIDE) -> DataFrame:
    """The best phrases of each language: ``lang``, ``rank``, ``phrase``, occurrences of the
    phrase (``a``), of its parts (``l``, ``r``) and of all words (``n``), and ``score``."""
    texts = docs.select(
        F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text")
    )
    words = staged(_counted(texts, _count_words, 1, least), "phrases-words")
    totals = words.where("w1 is null").select("lang", F.col("a").alias("n"))
    words = words.where("w1 is not null")
    words_bits = Bits(words.select("lang", "w1"))
    counted = _counted(texts, _count_pairs(words_bits), 2, least)
    pairs = staged(_pairs(counted, words), "phrases-pairs")
    pairs_bits = Bits(pairs.select("lang", "w1", "w2"))

    rank, before, triples = 2 * top, None, None
    while True:
        now = staged(_thresholds(pairs, rank), "phrases-thresholds")
        if before is not None:
            # A language that is done keeps its threshold and asks for nothing more.
            kept = before.select("lang", F.col("least").alias("last"), "done")
            now = staged(
                now.join(kept, "lang").select(
                    "lang", F.when(F.col("done"), F.col("last")).otherwise(F.col("least")).alias("least"), "last"
                ),
                "phrases-thresholds",
            )
        else:
            now = now.withColumn("last", F.lit(None).cast("bigint"))
        near = pairs.join(now, "lang")
        new = F.col("last").isNull()
        grown = near.where((F.col("bound") >= F.col("least")) & (new | (F.col("bound") < F.col("last"))))
        settled = near.where((F.col("score") >= F.col("least")) & (new | (F.col("score") < F.col("last"))))
        step = _count_triples(
            words_bits,
            pairs_bits,
            Bits(grown.select("lang", "w1", "w2")),
            Bits(settled.select("lang", "w1", "w2")),
        )
        found = staged(_scored(_counted(texts, step, 3, least), pairs), "phrases-triples")
        triples = found if triples is None else triples.unionAll(found).distinct()
        best = _survivors(pairs, triples, inside).join(now, "lang").where("score >= least")
        reached = best.groupBy("lang").agg(F.count("*").alias("n_reached"))
        before = staged(
            now.join(reached, "lang", "left").select(
                "lang",
                "least",
                ((F.coalesce("n_reached", F.lit(0)) >= top) | (F.col("least") <= 0)).alias("done"),
            ),
            "phrases-rounds",
        )
        if before.where("not done").isEmpty():
            break
        rank *= 2
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = best.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    first = Window.partitionBy("lang", "salt").orderBy(*order)
    fewer = salted.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= top)
    ranked = fewer.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    columns = [F.col(c).cast("bigint").alias(c) for c in ("a", "l", "r", "n", "score")]
    return ranked.where(F.col("rank") <= top).join(totals, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", *columns
    )
