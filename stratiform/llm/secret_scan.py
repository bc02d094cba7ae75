"""Secrets in texts: three stated patterns, and strings too random to be text.

The patterns (``PATTERNS``) find assignments to names like ``password``, access keys and long
hexadecimal strings. Every other run of at least ``LEAST`` symbols that fits an encoding is a
candidate. Its encoding is the smallest alphabet that holds all of it. Three tests then ask
whether it could be ordinary text, as the symbols and pairs of neighbours counted over all
shorter runs of the corpus describe that:

* *Uniformity*: the chi-squared statistic of its symbols against the alphabet, compared with
  what the symbols of ordinary text give at that length;
* *Runs*: how often the kind of symbol (small, capital, digit) changes;
* *Serial correlation*: how strongly neighbours go together beyond their kinds, as the mean
  of their mutual information; in random strings they do not.

The three deviations are cut at ``CUT`` standard deviations, so none decides alone, and added
(Stouffer). False discoveries are controlled by Benjamini and Hochberg's rule at ``RATE``, in
each band of lengths apart: short strings, where the tests say little, cannot borrow from long
ones. The counts behind it are histograms of fixed size over all candidates of the corpus.

Null texts count as empty and have no spans. Repeated rows each get their own; other columns
are ignored, whatever their names. Whole texts are read, however long. Patterns come first:
what overlaps one of their spans is no candidate. Of equal starts, spans go by kind as listed.
Empty tables give empty results. Positions are code points, the end is exclusive.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from stratiform.llm.common import staged

# Name, pattern, what counts for the least length, and that length.
PATTERNS = (
    (
        "assign",
        re.compile(
            r"""((?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
            re.IGNORECASE | re.ASCII,
        ),
        2,
        6,
    ),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    # Runs of at least the length are the same as runs of which the shorter are dropped.
    ("hex", re.compile(r"[0-9a-f]{24,}"), 0, 24),
)
KINDS = tuple(name for name, *_ in PATTERNS)
RANDOM = "random"

SMALL, CAPITAL, DIGIT = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
SYMBOLS = SMALL + CAPITAL + DIGIT + "+/-_"
# Alphabets, from small to large; the first that holds a string is its encoding.
ENCODINGS = (
    ("base16", DIGIT + "abcdef"),
    ("base16 upper", DIGIT + "ABCDEF"),
    ("letters", SMALL),
    ("base32", CAPITAL + "234567"),
    ("base36", SMALL + DIGIT),
    ("base36 upper", CAPITAL + DIGIT),
    ("base62", SMALL + CAPITAL + DIGIT),
    ("base64", SMALL + CAPITAL + DIGIT + "+/"),
    ("base64 url", SMALL + CAPITAL + DIGIT + "-_"),
)
LEAST = 20
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_-]{{{LEAST},}}")
BANDS = (LEAST, 24, 32, 48, 64, 128)
CUT, RATE = 4.0, 0.01
# Running text changes the kind of symbol seldom; names made of several words may do so as
# often as this.
LEAST_CHANGES = 0.2
# Pairs that are rare in the corpus say little: this many of each, and this share of all, are
# added as if independent.
PRIOR_EACH, PRIOR_SHARE = 3, 0.05
STEP = 0.1

_N = len(SYMBOLS) + 1  # all other bytes are the last code
_CODE = np.full(256, _N - 1, np.int64)
_CODE[list(SYMBOLS.encode())] = np.arange(_N - 1)
_KIND = np.array([0] * 26 + [1] * 26 + [2] * 10 + [3] * 5)

SPAN = "struct<kind:string, start:bigint, end:bigint>"
FOUND = (
    f"doc_id {{id}}, base array<{SPAN}>, candidates array<struct<kind:string, start:bigint, "
    "end:bigint, encoding:string, band:int, uniformity:double, runs:double, serial:double, "
    "score:double>>"
)


# --- what ordinary text looks like -------------------------------------------


def pair_counts(docs: DataFrame) -> np.ndarray:
    """How often each symbol of all texts is followed by each; of fixed size.

    Runs that are long enough to be candidates do not count as ordinary text.
    """

    def short(codes):
        edges = np.flatnonzero(np.diff(codes == _N - 1)) + 1
        lengths = np.diff(np.concatenate([[0], edges, [len(codes)]]))
        return np.where(np.repeat(lengths < LEAST, lengths), codes, _N - 1)

    def count(batches):
        total = np.zeros(_N * _N, np.int64)
        for batch in batches:
            for text in batch.column(0):
                if not text.is_valid:
                    continue
                codes = _CODE[np.frombuffer(text.as_buffer(), np.uint8)]
                if len(codes) > 1:
                    codes = short(codes)
                    total += np.bincount(codes[:-1] * _N + codes[1:], minlength=_N * _N)
        pairs = np.flatnonzero(total)
        yield pa.record_batch({"pair": pairs, "n": total[pairs]})

    rows = docs.select("text").mapInArrow(count, "pair bigint, n bigint")
    counts = np.zeros(_N * _N)
    for pair, n in rows.groupBy("pair").agg(F.sum("n")).collect():
        counts[pair] = n
    return counts.reshape(_N, _N)


class OrdinaryText:
    """What the tests expect of ordinary text, by encoding."""

    def __init__(self, counts: np.ndarray):
        counts = counts[:-1, :-1]
        single = counts.sum(axis=1) + 1
        share = single / single.sum()
        self.information = self._information(counts)
        counts = counts + 0.5
        self.expected = {}
        for name, alphabet in ENCODINGS:
            own = _CODE[list(alphabet.encode())]
            p = share[own] / share[own].sum()
            pairs = counts[np.ix_(own, own)]
            pairs /= pairs.sum()
            plain = _KIND[own] < 3
            kinds = _KIND[own][plain]
            inside = pairs[np.ix_(plain, plain)]
            changes = inside[kinds[:, None] != kinds].sum() / inside.sum()
            known = self.information[np.ix_(own, own)]
            mean = float((pairs * known).sum())
            spread = math.sqrt(float((pairs * (known - mean) ** 2).sum()))
            self.expected[name] = (
                len(alphabet),
                float((p**2).sum()),
                float((p**3).sum()),
                max(float(changes), LEAST_CHANGES) if len(set(kinds)) > 1 else None,
                mean,
                spread,
            )

    @staticmethod
    def _information(counts: np.ndarray) -> np.ndarray:
        """How much more often than their kinds explain each symbol is followed by each, as a log."""
        result = np.zeros_like(counts)
        for first in range(4):
            for second in range(4):
                block = np.ix_(_KIND[: _N - 1] == first, _KIND[: _N - 1] == second)
                seen = counts[block]
                rows, columns = seen.sum(axis=1) + 1, seen.sum(axis=0) + 1
                apart = np.outer(rows / rows.sum(), columns / columns.sum())
                prior = PRIOR_EACH * seen.size + PRIOR_SHARE * seen.sum()
                result[block] = np.log((seen + prior * apart) / ((seen.sum() + prior) * apart))
        return result

    def deviations(self, encoding: str, codes: np.ndarray) -> tuple[float, float | None, float]:
        """By how many standard deviations a string is more random than ordinary text."""
        size, squares, cubes, changes, mean, spread = self.expected[encoding]
        n = len(codes)
        # Chi-squared is size / n * sum of squared counts - n: linear in the pairs of equal
        # symbols, whose mean and variance under any shares of symbols are exact.
        observed = np.bincount(codes, minlength=_N)
        chi = size / n * float((observed.astype(float) ** 2).sum()) - n
        pairs = n * (n - 1) / 2
        expected = size / n * (2 * pairs * squares + n) - n
        variance = pairs * (squares - squares**2) + 2 * pairs * (n - 2) * (cubes - squares**2)
        uniformity = (expected - chi) / (2 * size / n * math.sqrt(max(variance, 1e-9)))
        kinds = _KIND[codes]
        steps = (kinds[:-1] < 3) & (kinds[1:] < 3)
        runs = None
        if changes is not None and steps.sum() > 1:
            m = int(steps.sum())
            seen = int((steps & (kinds[:-1] != kinds[1:])).sum())
            runs = (seen - 0.5 - m * changes) / math.sqrt(m * changes * (1 - changes))
        together = float(self.information[codes[:-1], codes[1:]].mean())
        serial = (mean - together) / (max(spread, 1e-9) / math.sqrt(n - 1))
        return uniformity, runs, serial


def encoding_of(string: str) -> str | None:
    """The smallest alphabet that holds the string; none for digits alone or mixed alphabets."""
    symbols = set(string)
    if symbols <= set(DIGIT):
        return None
    return next((name for name, alphabet in ENCODINGS if symbols <= set(alphabet)), None)


def score(deviations) -> float:
    """The deviations that could be measured as one, standard normal for ordinary text."""
    measured = [min(max(d, -CUT), CUT) for d in deviations if d is not None]
    return sum(measured) / math.sqrt(len(measured))


# --- spans -------------------------------------------------------------------


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Start, kind and end of what the patterns find, in order."""
    spans = []
    for kind, (_, pattern, group, least) in enumerate(PATTERNS):
        for match in pattern.finditer(text):
            start, end = match.span(group)
            if end - start >= least:
                spans.append((match.start(), kind, match.end()))
    return sorted(spans)


def _candidates(text: str, base: list, ordinary: OrdinaryText) -> Iterator[dict]:
    for match in CANDIDATE.finditer(text):
        start, end = match.span()
        if any(s < end and start < e for s, _, e in base):
            continue
        encoding = encoding_of(match.group())
        if encoding is None:
            continue
        codes = _CODE[list(match.group().encode())]
        uniformity, runs, serial = ordinary.deviations(encoding, codes)
        yield {
            "kind": RANDOM,
            "start": start,
            "end": end,
            "encoding": encoding,
            "band": bisect_right(BANDS, end - start) - 1,
            "uniformity": uniformity,
            "runs": runs,
            "serial": serial,
            "score": score((uniformity, runs, serial)),
        }


def _found(docs: DataFrame, ordinary: OrdinaryText) -> DataFrame:
    schema = FOUND.format(id=docs.schema["doc_id"].dataType.simpleString())
    fields = to_arrow_schema(T.StructType.fromDDL(schema))

    def find(batches):
        for batch in batches:
            base, candidates = [], []
            for text in batch.column(1).to_pylist():
                spans = base_spans(text or "")
                base.append([{"kind": KINDS[k], "start": s, "end": e} for s, k, e in spans])
                candidates.append(list(_candidates(text or "", spans, ordinary)))
            columns = [
                batch.column(0).cast(fields[0].type),
                pa.array(base, fields[1].type),
                pa.array(candidates, fields[2].type),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=fields)

    return docs.select("doc_id", "text").mapInArrow(find, schema)


def thresholds(histogram: dict[tuple[int, int], int]) -> list[float]:
    """By band, the least score that counts: Benjamini and Hochberg's rule on steps of scores.

    ``histogram`` counts candidates by band and by score in whole steps.
    """
    result = []
    for band in range(len(BANDS)):
        steps = {step: n for (b, step), n in histogram.items() if b == band}
        total, least = sum(steps.values()), math.inf
        reached = 0
        for step in sorted(steps, reverse=True):
            reached += steps[step]
            chance = math.erfc(step * STEP / math.sqrt(2)) / 2
            if chance * total <= RATE * reached:
                least = step * STEP
        result.append(least)
    return result


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id`` and its ``spans`` in order: kind, start and end, and for those of kind
    ``random`` the encoding and the score."""
    found = staged(_found(docs, OrdinaryText(pair_counts(docs))), "secrets-found")
    step = F.floor(F.col("c.score") / STEP + 1e-9)
    counted = (
        found.select(F.explode("candidates").alias("c"))
        .groupBy("c.band", step.alias("step"))
        .count()
        .collect()
    )
    least = thresholds({(r["band"], r["step"]): r["count"] for r in counted})
    bounds = F.array(*[F.lit(float(v)) for v in least])
    taken = F.filter(
        "candidates",
        lambda c: F.floor(c["score"] / STEP + 1e-9) * STEP >= F.get(bounds, c["band"]) - STEP / 2,
    )
    order = F.array(*[F.lit(k) for k in (*KINDS, RANDOM)])

    def span(s, encoding, score):
        return F.struct(
            s["start"].alias("start"),
            F.array_position(order, s["kind"]).alias("place"),
            s["end"].alias("end"),
            s["kind"].alias("kind"),
            encoding.cast("string").alias("encoding"),
            score.cast("double").alias("score"),
        )

    own = F.transform("base", lambda s: span(s, F.lit(None), F.lit(None)))
    more = F.transform(taken, lambda s: span(s, s["encoding"], s["score"]))
    return found.select("doc_id", F.array_sort(F.concat(own, more)).alias("spans"))


def named(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    each = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    return F.array_join(each, ",")


def report(docs: DataFrame) -> DataFrame:
    """Counts by kind, a digest of what the patterns found, and all spans as text."""
    base = F.filter("spans", lambda s: s["kind"] != RANDOM)

    def number(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    return scan(docs).select(
        "doc_id",
        *[number(kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(named(base), 256).alias("base_sha256"),
        named(F.col("spans")).alias("spans"),
    )
