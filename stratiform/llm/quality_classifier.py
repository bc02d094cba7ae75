"""Quality of documents from a conditional random field over their lines.

Each line is good or bad. Its features are its own, some of the lines before and after,
and some of the document; transitions between neighbouring lines are learned with them.
Training lines carry the label of their document. A document's score is the mean of its
lines' probabilities of being good, by forward-backward, weighted with their length.

The field is fitted on a sample of labelled rows, chosen by hashes of the id: at most about
``train_rows`` of them and ``TRAIN_BYTES`` of text, whole texts of at most ``TRAIN_TEXT`` bytes.
Scoring is one pass without a shuffle; long texts are handled line by
line, a few hundred bytes each.

Null and empty texts are one empty line. Rows without a label are scored all the same.
Without any labelled row every score is 0.5. Several labels of one document: the smallest
counts. Repeated rows are repeated, other columns are not inputs, an empty table gives an
empty table. A null id is never held out, and never learned from.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiform.llm.batching import blocks, padded
from stratiform.llm.common import remainder, sampled

TRAIN_ROWS = 6_000
TRAIN_BYTES = 32 * 1024**2
TRAIN_TEXT = TRAIN_BYTES // 32
STEPS, RATE, DECAY = 200, 0.05, 1e-3
ROWS = 400  # texts worked on at a time

_CLASSES = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "#*$%&<>", "|", "!", ".,;:?", " \t")
_NEAR = slice(0, 9)  # the features also taken from the lines before and after


def _lookup() -> np.ndarray:
    table = np.zeros((len(_CLASSES) + 1, 256), bool)
    for k, characters in enumerate(_CLASSES):
        table[k, list(characters.encode())] = True
    table[-1, 128:] = True
    return table


_TABLE = _lookup()


@dataclass
class Lines:
    features: np.ndarray
    sizes: np.ndarray
    firsts: np.ndarray
    lengths: np.ndarray


def lines(texts: list[str | None]) -> Lines:
    """Features of all lines of some texts."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    split = [r.split(b"\n") for r in raw]
    lengths = np.array([len(s) for s in split])
    flat = [x for s in split for x in s]
    sizes = np.array([len(x) for x in flat])
    data = np.frombuffer(b"".join(flat), np.uint8)
    ends = np.cumsum(sizes)
    counts = []
    for member in _TABLE:
        running = np.concatenate([[0], np.cumsum(member[data], dtype=np.int32)])
        counts.append(running[ends] - running[ends - sizes])
    upper, digit, symbol, bar, bang, stop, space, far = np.array(counts, np.float64)
    size = np.maximum(sizes, 1)
    again, fresh, doc_fresh, doc_again = [], [], [], []
    for s in split:
        seen: set[bytes] = set()
        every: set[bytes] = set()
        n = 0
        for x in s:
            again.append(x in seen and bool(x))
            seen.add(x)
            words = x.split()
            fresh.append(len(set(words)) / len(words) if words else 1.0)
            every.update(words)
            n += len(words)
        doc_fresh.append(len(every) / n if n else 1.0)
        doc_again.append(sum(again[len(again) - len(s) :]) / len(s))
    words = space + 1
    own = np.stack(
        [
            upper / size,
            symbol / size * 4,
            bar / words,
            bang / words,
            np.array(again, float),
            np.array(fresh),
            digit / size,
            stop / words,
            symbol / words > 0.3,
            np.log1p(sizes) / 8,
            sizes / words / 10,
            far / size,
            upper / size > 0.4,
            bar / words > 0.1,
            sizes == 0,
        ],
        1,
    )
    firsts = np.cumsum(lengths) - lengths
    before, after = np.zeros_like(own[:, _NEAR]), np.zeros_like(own[:, _NEAR])
    before[1:], after[:-1] = own[:-1, _NEAR], own[1:, _NEAR]
    before[firsts], after[firsts + lengths - 1] = 0, 0
    doc = np.stack(
        [doc_fresh, doc_again, np.log1p(lengths) / 5, np.log1p([len(r) for r in raw]) / 10], 1
    )
    features = np.hstack([own, before, after, np.repeat(doc, lengths, 0), np.ones((len(own), 1))])
    return Lines(features.astype(np.float32), sizes, firsts, lengths)


@dataclass
class Field:
    """Weights of the features for good over bad, and of transitions (from, to)."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    moves: np.ndarray

    def emissions(self, features: np.ndarray) -> np.ndarray:
        return ((features - self.mean) / self.scale) @ self.weights


def forward_backward(emit: np.ndarray, real: np.ndarray, moves: np.ndarray):
    """Probability of good per step, and of each move summed over steps; sequences side by side.

    ``emit`` is the log odds of good by step and sequence, ``real`` is false below the end.
    """
    steps, rows = emit.shape
    own = np.stack([np.zeros_like(emit), np.where(real, emit, 0)], 2)
    ahead, back = np.zeros_like(own), np.zeros_like(own)
    ahead[0] = own[0]
    for t in range(1, steps):
        new = np.logaddexp(
            ahead[t - 1, :, :1] + moves[0], ahead[t - 1, :, 1:] + moves[1]
        ) + own[t]
        ahead[t] = np.where(real[t][:, None], new, ahead[t - 1])
    for t in range(steps - 2, -1, -1):
        ends = back[t + 1] + own[t + 1]
        new = np.logaddexp(ends[:, :1] + moves[:, 0], ends[:, 1:] + moves[:, 1])
        back[t] = np.where(real[t + 1][:, None], new, 0)
    total = np.logaddexp(ahead[-1, :, 0], ahead[-1, :, 1])
    good = np.exp(ahead[..., 1] + back[..., 1] - total)
    pair = ahead[:-1, :, :, None] + moves + (own[1:] + back[1:])[:, :, None, :]
    pair = np.exp(pair - total[:, None, None]) * real[1:, :, None, None]
    return np.where(real, good, 0), pair.sum((0, 1))


def _marginals(field: Field, found: Lines) -> np.ndarray:
    emit = np.append(field.emissions(found.features), 0)
    good = np.zeros(len(emit))
    for rows in blocks(found.lengths, cells=1 << 16):
        at = padded(found.firsts[rows], found.lengths[rows], len(emit) - 1)
        real = at < len(emit) - 1
        good[at] = forward_backward(emit[at], real, field.moves)[0]
    return good[:-1]


def fit(texts: list[str | None], labels: np.ndarray) -> Field:
    """Gradient ascent on the likelihood of the labels of all lines."""
    parts = [lines(texts[k : k + ROWS]) for k in range(0, len(texts), ROWS)]
    features = np.vstack([p.features for p in parts])
    lengths = np.concatenate([p.lengths for p in parts])
    firsts = np.cumsum(lengths) - lengths
    mean, scale = features.mean(0), features.std(0)
    mean[-1], scale[-1] = 0, 1
    scale[scale < 1e-6] = 1
    field = Field(mean, scale, np.zeros(features.shape[1]), np.zeros((2, 2)))
    plain = (features - mean) / scale
    truth = np.repeat(labels, lengths).astype(float)
    of_doc = np.repeat(1 / lengths, lengths)  # every document counts the same
    held = [(padded(firsts[r], lengths[r], len(plain)), r) for r in blocks(lengths, cells=1 << 16)]
    first, second = np.zeros(len(field.weights) + 4), np.zeros(len(field.weights) + 4)
    for step in range(1, STEPS + 1):
        emit, good, moves = np.append(plain @ field.weights, 0), np.zeros(len(plain) + 1), 0.0
        for at, rows in held:
            real = at < len(plain)
            found, pairs = forward_backward(emit[at], real, field.moves)
            good[at] = found
            ones = int((np.maximum(lengths[rows] - 1, 0) * (labels[rows] == 1)).sum())
            zeros = int((np.maximum(lengths[rows] - 1, 0) * (labels[rows] == 0)).sum())
            moves = moves + np.array([[zeros, 0], [0, ones]]) - pairs
        slope = plain.T @ ((truth - good[:-1]) * of_doc) / len(lengths)
        slope = np.concatenate([slope - DECAY * field.weights, (moves / len(plain)).ravel()])
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        move = RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        field.weights += move[:-4]
        field.moves += move[-4:].reshape(2, 2)
    return field


def train(labelled: DataFrame, train_bytes: int = TRAIN_BYTES) -> Field | None:
    """Fitted on whole texts, at most about ``train_bytes`` together, of rows of ``doc_id``,
    ``text`` and ``quality``."""
    known = labelled.where(F.col("quality").isNotNull())
    some = known.where(F.coalesce(F.octet_length("text"), F.lit(0)) <= TRAIN_TEXT)
    part = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(1000))
    some = some.withColumn("_part", part)
    sizes = some.groupBy("_part").agg(F.sum(F.octet_length("text")).alias("n")).toPandas()
    sizes = sizes.fillna(0).sort_values("_part")
    within = sizes["_part"][sizes["n"].cumsum() <= train_bytes]
    if within.empty:
        return None
    some = some.where(F.col("_part") <= int(within.max()))
    rows = some.select("text", "quality").orderBy("doc_id").toPandas()
    texts = [t if isinstance(t, str) else None for t in rows["text"]]
    return fit(texts, rows["quality"].to_numpy().astype(int))


def score(docs: DataFrame, field: Field | None) -> DataFrame:
    """``doc_id``, score and the marginal of each line of each document."""
    held = docs.sparkSession.sparkContext.broadcast(field)  # a few hundred numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                found = lines(batch.column("text").to_pylist())
                good = np.full(len(found.sizes), 0.5)
                if held.value is not None:
                    good = _marginals(held.value, found)
                weight = np.maximum(found.sizes, 1e-3)
                total = np.add.reduceat(good * weight, found.firsts)
                mean = np.clip(total / np.add.reduceat(weight, found.firsts), 0, 1)
                cuts = pa.array(np.append(found.firsts, len(good)), pa.int32())
                each = pa.ListArray.from_arrays(cuts, pa.array(good, pa.float64()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(mean, pa.float64()), each],
                    ["doc_id", "score", "line_scores"],
                )

    schema = "doc_id bigint, score double, line_scores array<double>"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Trained on the labelled rows that are not held out, applied to all."""
    fold = remainder(F.col("doc_id"), 3)
    known = labels.where((fold != 1) & F.col("quality").isNotNull())
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    known = sampled(known, F.col("doc_id"), TRAIN_ROWS)
    texts = docs.where(fold != 1).select("doc_id", "text")
    field = train(texts.join(known, "doc_id"))
    return score(docs, field).select(
        "doc_id",
        F.coalesce(fold == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
