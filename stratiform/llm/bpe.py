"""BPE encoding and decoding of whole texts.

A piece of text starts as a doubly linked list of symbols, one per byte, the last marked
as a word end. A priority queue holds the adjacent pairs that the vocabulary can merge, by
merge rank and place; the best pair is merged, its neighbours' new pairs are queued, and
entries whose symbols have changed meanwhile are skipped when they come up. Decoding puts
the vocabulary strings of the ids together again, as the vocabulary's own decoder does
where it names none: with one space between.

Pieces are cut at white space and merges never cross it, so each different piece is worked
out once and looked up after that; what was not looked up for long is forgotten and worked
out anew, which changes no result. Rows are independent: no shuffle, nothing to skew.

Null is an empty text with no ids. Repeated rows, ties and other columns need no care; an
empty table gives an empty table.
"""

from __future__ import annotations

import functools
import hashlib
import json
import unicodedata
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import pairwise

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

VOCABULARY = "word_bpe_49k.json"
REMEMBERED = 250_000

_PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+")
_GAPS = regex.compile(r"\p{White_Space}+")
# str.split() also parts at these, which are no white space of the vocabulary's pattern.
_SEPARATORS = regex.compile("[\x1c-\x1f]")


def _byte_symbols() -> list[str]:
    """The printable character that stands for each byte: bytes that print stand for
    themselves, the others take characters from 256 on, in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in plain else next(others)) for b in range(256)]


class Bpe:
    """Encoder and decoder of one vocabulary file with word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.end = model["end_of_word_suffix"] or ""
        self.ids: dict[str, int] = model["vocab"]
        ids = self.ids
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        pairs = [tuple(pair) for pair in pairs]
        self._ranks = {ids[a] << 16 | ids[b]: rank for rank, (a, b) in enumerate(pairs)}
        self._made = [ids[a + b] for a, b in pairs]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = {i: s for s, i in [*self.ids.items(), *self.special.items()]}
        symbols = _byte_symbols()
        self._inner = [ids[s] for s in symbols]
        self._last = [ids[s + self.end] for s in symbols]
        self._special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self._known: dict[str, tuple[tuple[int, ...], str, str]] = {}
        self._older = self._known
        self._pieces: dict[str, tuple[int, ...]] = {}

    def merged(self, piece: str) -> tuple[int, ...]:
        """The ids of one piece after all merges.

        A queue entry is merge rank and place in one number; ``waiting`` has the rank that
        a place now offers, so an entry with another rank is stale.
        """
        raw = piece.encode("utf-8", "surrogatepass")
        inner, rank_of, made, push, pop = self._inner, self._ranks.get, self._made, heappush, heappop
        symbols = [inner[b] for b in raw]
        symbols[-1] = self._last[raw[-1]]
        size = len(symbols)
        waiting = [rank_of(a << 16 | b, -1) for a, b in pairwise(symbols)]
        waiting.append(-1)
        queue = [rank << 24 | k for k, rank in enumerate(waiting) if rank >= 0]
        if not queue:
            return tuple(symbols)
        heapify(queue)
        before = list(range(-1, size - 1))
        after = list(range(1, size + 1))
        while queue:
            entry = pop(queue)
            left, rank = entry & 0xFFFFFF, entry >> 24
            if waiting[left] != rank:
                continue
            symbol = symbols[left] = made[rank]
            right = after[left]
            symbols[right] = waiting[right] = -1
            following = after[left] = after[right]
            if following < size:
                before[following] = left
                rank = waiting[left] = rank_of(symbol << 16 | symbols[following], -1)
                if rank >= 0:
                    push(queue, rank << 24 | left)
            else:
                waiting[left] = -1
            previous = before[left]
            if previous >= 0:
                rank = waiting[previous] = rank_of(symbols[previous] << 16 | symbol, -1)
                if rank >= 0:
                    push(queue, rank << 24 | previous)
        return tuple([s for s in symbols if s >= 0])

    def _encode_chunk(self, chunk: str) -> list[int]:
        """Ids of a run without white space."""
        out: list[int] = []
        for part in self._special.split(chunk) if "<|" in chunk else (chunk,):
            if part in self.special:
                out.append(self.special[part])
                continue
            if part.isascii():
                plain = part.lower()
            else:
                plain = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
            for piece in (plain,) if plain.isalpha() else _PIECE.findall(plain):
                ids = self._pieces.get(piece)
                if ids is None:
                    ids = self.merged(piece)
                    if len(piece) < 30:
                        self._pieces[piece] = ids
                out += ids
        if len(self._pieces) > REMEMBERED:
            self._pieces = {}
        return out

    def _chunk(self, chunk: str) -> tuple[tuple[int, ...], str, str]:
        known = self._older.get(chunk)
        if known is None:
            ids = tuple(self._encode_chunk(chunk))
            known = (ids, " ".join(map(str, ids)), self.decode(ids))
        if len(chunk) < 30:
            self._known[chunk] = known
        return known

    def chunks(self, text: str) -> list[tuple[tuple[int, ...], str, str]]:
        """Per run without white space: its ids, these as text, and the decoded text."""
        runs = _GAPS.split(text) if _SEPARATORS.search(text) else text.split()
        if len(self._known) > REMEMBERED:
            self._older, self._known = self._known, {}
        get, make = self._known.get, self._chunk
        return [k for run in runs if run and (k := get(run) or make(run))[0]]

    def encode(self, text: str) -> list[int]:
        return [i for ids, _, _ in self.chunks(text) for i in ids]

    def decode(self, ids: list[int]) -> str:
        return " ".join([self.strings[i] for i in ids])


@functools.lru_cache(maxsize=2)
def encoder(path: str | None = None) -> Bpe:
    """One encoder per worker. Without a path, the installed vocabulary on that machine."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    return Bpe(path)


def bpe(docs: DataFrame, path: str | None = None, texts: bool = False) -> DataFrame:
    """Ids and decoded text of each document: digests, or with ``texts`` the things themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for batch in batches:
            counts, ids, decoded = [], [], []
            for text in batch.column("text"):
                found = coder.chunks(text.as_py() or "")
                counts.append(sum(len(k[0]) for k in found))
                ids.append(" ".join([k[1] for k in found]))
                decoded.append(" ".join([k[2] for k in found]))
                if not texts:
                    for column in (ids, decoded):
                        plain = column[-1].encode("utf-8", "surrogatepass")
                        column[-1] = hashlib.sha256(plain).hexdigest()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(counts, pa.int64()),
                    pa.array(ids, pa.string()),
                    pa.array(decoded, pa.string()),
                ],
                ["doc_id", "n_tokens", *names],
            )

    names = ["ids", "decoded"] if texts else ["ids_sha256", "decoded_sha256"]
    schema = f"doc_id bigint, n_tokens bigint, {names[0]} string, {names[1]} string"
    return docs.select("doc_id", "text").mapInArrow(run, schema)
