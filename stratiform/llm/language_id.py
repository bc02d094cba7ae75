"""Language of whole texts, spans of mixed text included.

Words are scored for each language by the log probabilities of their hashed character
n-grams; the script of a word narrows the languages that compete for it. Viterbi with a
penalty for switching labels each word of a text, neighbouring words with one label are a
span, and the language with most letters is the text's, its share of letters the score.

The model is counted, distributed, over a sample of the labelled rows whose bound is the
parameter ``train_rows``, in equal parts for all languages and all rows of rare ones; the collected table has a fixed number of buckets per language.
Prediction is one pass without a shuffle. Very long texts are labelled in place: memory is
a few bytes per word.

Null texts and texts without letters are ``und`` with score 0, as is every text when
nothing could be learned. Letters of a script no language was learned in weigh nothing.
Ties go to the first language by name. Repeated rows are repeated, other columns are not
inputs, an empty table gives an empty table.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiform.llm.batching import blocks, padded
from stratiform.llm.common import remainder

BUCKETS = 1 << 16
TRAIN_ROWS = 20_000
PENALTY = 8.0
REMEMBERED = 200_000
WORDS = 5_000  # new words scored at a time
_PARTS = 1_000_003
SCRIPT_SHARE = 0.01  # of a language's words that must be in a script for it to compete there

# First code point of each range of letters, and its script.
SCRIPTS = (
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"),
    (0x0590, "Hebrew"), (0x0600, "Arabic"), (0x0700, "Other"), (0x0900, "Devanagari"),
    (0x0980, "Bengali"), (0x0A00, "Other"), (0x0B80, "Tamil"), (0x0C00, "Other"),
    (0x0E00, "Thai"), (0x0E80, "Other"), (0x10A0, "Georgian"), (0x1100, "Hangul"),
    (0x1200, "Other"), (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, "Other"),
    (0x2C60, "Latin"), (0x2C80, "Other"), (0x3040, "Kana"), (0x3100, "Other"),
    (0x3130, "Hangul"), (0x31A0, "Other"), (0x3400, "Han"), (0xA000, "Other"),
    (0xA720, "Latin"), (0xA800, "Other"), (0xAC00, "Hangul"), (0xD7B0, "Other"),
    (0xF900, "Han"), (0xFB00, "Latin"), (0xFB13, "Other"), (0xFF21, "Latin"), (0xFF66, "Kana"),
    (0xFFA0, "Other"), (0x20000, "Han"), (0x32000, "Other"),
)
_STARTS = [s for s, _ in SCRIPTS]
_NAMES = sorted({n for _, n in SCRIPTS})
_PLACES = [_NAMES.index(n) for _, n in SCRIPTS]
_WORD = re.compile(r"[^\W\d_]+")


def script(word: str) -> int:
    return _PLACES[bisect_right(_STARTS, ord(word[0])) - 1]


def grams(word: str) -> list[int]:
    """Buckets of a word: its n-grams of two to four letters with marked ends, and itself."""
    marked = f"\x02{word}\x03".encode("utf-32-le", "surrogatepass")
    size = len(marked)
    out = [zlib.crc32(marked[i : i + 4 * n]) for n in (2, 3, 4) for i in range(0, size - 4 * n + 1, 4)]
    out.append(zlib.crc32(marked, 1))
    return [x % BUCKETS for x in out]


@dataclass
class Model:
    languages: list[str]
    scores: np.ndarray  # buckets by languages
    competes: np.ndarray  # scripts by languages

    def words(self, words: list[str]) -> np.ndarray:
        """Scores of words per language; none where no language has a word's script."""
        found = [grams(word) for word in words]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter(chain.from_iterable(found), np.int64, sizes.sum())
        own = np.add.reduceat(self.scores[flat], sizes.cumsum() - sizes) / 3
        competes = self.competes[[script(word) for word in words]]
        best = np.where(competes, own, -np.inf).max(1, keepdims=True)
        known = competes.any(1, keepdims=True)
        out = np.where(competes, own - np.where(known, best, 0), -30.0)
        return np.where(known, out, 0).astype(np.float32)


def train(labelled: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """Counts n-grams and scripts per language over rows of ``text`` and ``lang``."""
    known = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    names = sorted(sizes)
    place = {name: k for k, name in enumerate(names)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(names), BUCKETS + len(_NAMES)), np.int64)
        for batch in batches:
            words: dict[int, Counter] = {}
            for text, name in zip(batch.column("text"), batch.column("lang").to_pylist(), strict=True):
                words.setdefault(place[name], Counter()).update(_WORD.findall(text.as_py().lower()))
            for k, counted in words.items():
                for word, n in counted.items():
                    np.add.at(total[k], grams(word), n)
                    total[k, BUCKETS + script(word)] += n
        lang, bucket = total.nonzero()
        columns = (lang, bucket, total[lang, bucket])
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["l", "b", "n"])

    # Each language gives as many rows, a rare one all it has.
    each = train_rows // max(len(names), 1)
    sizes = sizes or {"": 1}
    shares = {name: int(min(1, each / n) * _PARTS) for name, n in sizes.items()}
    share = F.element_at(F.create_map(*[F.lit(v) for kv in shares.items() for v in kv]), F.col("lang"))
    some = known.select("doc_id", "text", "lang").where(
        F.pmod(F.xxhash64("doc_id"), F.lit(_PARTS)) < share
    )
    counts = some.mapInArrow(count, "l bigint, b bigint, n bigint").groupBy("l", "b")
    found = counts.agg(F.sum("n").alias("n")).toPandas()
    table = np.zeros((BUCKETS + len(_NAMES), len(names)))
    table[found["b"], found["l"]] = found["n"]
    seen, scripts = table[:BUCKETS], table[BUCKETS:]
    scores = np.log((seen + 0.1) / (seen.sum(0) + 0.1 * BUCKETS))
    share = scripts / np.maximum(scripts.sum(0), 1)
    return Model(names, scores.astype(np.float32), share >= SCRIPT_SHARE)


def viterbi(emissions: np.ndarray, penalty: float) -> np.ndarray:
    """Best label of each step for sequences side by side: steps, sequences, labels."""
    steps, rows, labels = emissions.shape
    back = np.empty((steps, rows, labels), np.uint8 if labels <= 256 else np.int32)
    score = emissions[0].copy()
    own = np.arange(labels)
    for t in range(1, steps):
        best = score.argmax(1)
        switched = score.max(1, keepdims=True) - penalty
        stays = score >= switched
        back[t] = np.where(stays, own, best[:, None])
        score = np.where(stays, score, switched) + emissions[t]
    path = np.empty((steps, rows), back.dtype)
    path[-1] = score.argmax(1)
    every = np.arange(rows)
    for t in range(steps - 1, 0, -1):
        path[t - 1] = back[t, every, path[t]]
    return path


class Labeller:
    """Labels the words of texts; scores of words are kept for the next texts."""

    def __init__(self, model: Model, penalty: float):
        self.model, self.penalty = model, penalty
        self.places: dict[str, int] = {}
        self.table = np.zeros((1 << 12, len(model.languages)), np.float32)
        # Letters of each word, and whether a language was learned that has its script.
        self.letters = np.zeros((1 << 12, 2), np.int64)

    def _learn(self, words: list[str]) -> None:
        """Give new words a row each; row 0 is no word."""
        first = len(self.places) + 1
        while first + len(words) > len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
            self.letters = np.concatenate([self.letters, np.zeros_like(self.letters)])
        self.places.update(zip(words, range(first, first + len(words)), strict=True))
        for k in range(0, len(words), WORDS):
            some = words[k : k + WORDS]
            self.table[first + k : first + k + len(some)] = self.model.words(some)
        # Numerals are matched as words, too, but hold no letter.
        self.letters[first : first + len(words), 0] = [
            len(w) if w.isalpha() else sum(map(str.isalpha, w)) for w in words
        ]
        learned = self.model.competes.any(1)
        self.letters[first : first + len(words), 1] = learned[[script(w) for w in words]]

    def label(self, texts: list[str | None]) -> list[tuple[str, float, list]]:
        if len(self.places) > REMEMBERED:
            self.places = {}
        places = self.places
        found = [_WORD.findall(t.lower()) if t else [] for t in texts]
        lengths = np.array([len(w) for w in found])
        firsts = np.cumsum(lengths) - lengths
        new = {w: None for ws in found for w in ws if w not in places}
        if new:
            self._learn(list(new))
        coded = np.array([places[w] for ws in found for w in ws] + [0], np.int32)
        out: list = [("und", 0.0, [])] * len(texts)
        names = self.model.languages
        for rows in blocks(lengths, cells=1 << 19):
            at = padded(firsts[rows], lengths[rows], len(coded) - 1)
            path = viterbi(self.table[coded[at]], self.penalty)
            letters = self.letters[coded[at]]
            held, weight = letters[..., 0].sum(0), letters[..., 0] * letters[..., 1]
            share = np.stack([(weight * (path == k)).sum(0) for k in range(len(names))], 1)
            winner = share.argmax(1)
            turns = path[1:] != path[:-1]
            for j, row in enumerate(rows):
                if not held[j]:
                    continue
                n = lengths[row]
                cuts = [0, *(np.flatnonzero(turns[: n - 1, j]) + 1).tolist(), n]
                spans = [
                    {"lang": names[path[a, j]], "first_word": a, "n_words": int(b - a)}
                    for a, b in zip(cuts, cuts[1:], strict=False)
                ]
                score = share[j, winner[j]] / max(share[j].sum(), 1)
                out[row] = (names[winner[j]], float(score), spans)
        return out


_SPANS = "array<struct<lang string, first_word bigint, n_words bigint>>"
_SPANS_ARROW = pa.list_(
    pa.struct([("lang", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64())])
)


def identify(docs: DataFrame, model: Model, penalty: float = PENALTY) -> DataFrame:
    """``doc_id``, language, score and spans of each document."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # buckets by languages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(held.value, penalty) if held.value.languages else None
        for whole in batches:
            for start in range(0, whole.num_rows, 2000):
                batch = whole.slice(start, 2000)
                texts = batch.column("text").to_pylist()
                found = labeller.label(texts) if labeller else [("und", 0.0, [])] * len(texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        pa.array([f[0] for f in found], pa.string()),
                        pa.array([f[1] for f in found], pa.float64()),
                        pa.array([f[2] for f in found], _SPANS_ARROW),
                    ],
                    ["doc_id", "lang_pred", "score", "spans"],
                )

    schema = f"doc_id bigint, lang_pred string, score double, spans {_SPANS}"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def language_id(docs: DataFrame) -> DataFrame:
    """Trained on the rows that are not held out, applied to all."""
    fold = remainder(F.col("doc_id"), 4)
    model = train(docs.where(fold != 2))
    found = identify(docs, model)
    return found.select("doc_id", F.coalesce(fold == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "spans")
