"""Lexical retrieval packing into training windows.

Documents become token ids once. Document frequencies of all documents give the BM25
weights; they are at most as many as the vocabulary has ids. Documents are put in order of
their heaviest terms among those common enough to fill a shard, and dealt in this order to
shards of a bounded number of tokens; terms with more documents part by the next heaviest,
equal ones by the id. Neighbours in other shards are not found, and the order brings only a
part of them together (the README has the measured share). Each shard is one inverted index: a
seed document opens a window, all its terms are scored, and the best unused
neighbours follow one after another until the window is full. What does not fit of the
last one opens the next window and is its seed, so windows have no padding; the rest at
the end of a shard is cut into sequences whose lengths are powers of two.

Null is an empty text: the closing id alone. Repeated rows are packed as often as they
come. Ties of scores go to the smaller id; a null id comes after all others. Other columns are not read; a text longer than
a window fills as many windows as it needs. An empty table gives an empty table.
"""

from __future__ import annotations

import functools
import re
import unicodedata
import zlib
from array import array
from collections.abc import Iterable, Iterator
from itertools import pairwise, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiform.llm.bpe import _PIECE, VOCABULARY, Bpe, _byte_symbols
from stratiform.llm.common import staged

WINDOW = 2048
CLOSING_ID = 1
SHARD_TOKENS = 1_000_000
DEALT_BY = 50  # documents per shard that are looked at to find the bounds of shards
REMEMBERED = 500_000  # pieces of words
LONG_PIECE = 32  # ids; longer ones are not remembered for long
TEXT_BYTES = 8 * 1024**2  # of text turned into ids at a time
ROWS = 1_000  # documents whose keys are worked out at a time
K1, B = 1.2, 0.75

# The pieces that the vocabulary cuts, or the end of a word, in lower-case text without other
# white space; the first for ASCII alone.
_ASCII_PIECE = re.compile(r"[a-z]+|\n|'(?:s|t|re|ve|m|ll|d)|[0-9]|[^\na-z0-9]+")
_PIECE_OR_END = regex.compile(r"\p{L}+|\n|" + _PIECE.pattern)

_TOKENS = "doc_id bigint, ids binary, n bigint"
_DEALT = ["doc_id", "ids", "n"]
_KEYED = "shard bigint, key bigint, " + _TOKENS
_PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint"
)


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places of ranges, one range after another."""
    reached = np.cumsum(lengths)
    total = int(reached[-1]) if len(reached) else 0
    return np.repeat(starts - reached + lengths, lengths) + np.arange(total)


class Words:
    """Ids of whole texts, worked out once per different word of a batch.

    The vocabulary drops white space and joins nothing across it, so the ids of a text are
    those of its words. The words of a batch are normalised together and cut into pieces as
    the vocabulary says. Each piece is merged by the tokenizers library and remembered; of
    too many or too long ones, the half that most batches used stays, without those over
    ``LONG_PIECE`` ids. That changes no result.
    """

    def __init__(self, path: str | None = None):
        from tokenizers import Tokenizer

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path(VOCABULARY)
        self.coder = Bpe(path)
        self._model = Tokenizer.from_file(path).model
        self._names = dict(enumerate(_byte_symbols()))
        # Each piece has a place, and its ids end at that place's stop. The first place is the
        # end of a word, without ids.
        self.places: dict[str, int] = {"\n": 0}
        self._ids, self._stops = array("H"), array("q", [0])
        self._uses = np.zeros(1, np.int64)

    def _learn(self, pieces: Iterable[str]) -> None:
        merged, places, ids, stops = self._model.tokenize, self.places, self._ids, self._stops
        for piece in pieces:
            raw = piece
            # The model knows bytes by symbols, which are the characters themselves only if
            # these can be seen.
            if not piece.isascii() or not piece.isprintable():
                raw = piece.encode("utf-8", "surrogatepass").decode("latin-1").translate(self._names)
            places[piece] = len(stops)
            ids.extend([t.id for t in merged(raw)])
            stops.append(len(ids))
        self._uses = np.r_[self._uses, np.zeros(len(stops) - len(self._uses), np.int64)]

    def _forget(self) -> None:
        """Keep the pieces that most batches used, but no long ones."""
        ids, stops = np.array(self._ids), np.array(self._stops)
        lengths = np.diff(stops, prepend=0)
        most = np.argsort(-self._uses[1:], kind="stable")[: REMEMBERED // 2] + 1
        kept = np.r_[0, np.sort(most[lengths[most] <= LONG_PIECE])]
        pieces = list(self.places)
        self.places = {pieces[k]: place for place, k in enumerate(kept.tolist())}
        self._ids = array("H", ids[_ranges(stops[kept] - lengths[kept], lengths[kept])].tobytes())
        self._stops = array("q", np.cumsum(lengths[kept]).tobytes())
        self._uses = self._uses[kept]

    def _of_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of words in some order; where those of each word begin, and how many they are."""
        plain = pc.string_is_ascii(words)
        pieces: list[str] = []
        for some, cut in ((plain, _ASCII_PIECE), (pc.invert(plain), _PIECE_OR_END)):
            part = words.filter(some)
            if len(part):
                # Line ends change nothing when all are normalised at once, and end a word.
                whole = pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), part)
                text = pc.binary_join(whole, "\n")[0].as_py() + "\n"
                if not text.isascii():
                    text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
                pieces += cut.findall(text.lower())
        known = self.places
        places = np.fromiter(map(known.get, pieces, repeat(-1)), np.int64, len(pieces))
        (new,) = (places < 0).nonzero()
        if len(new):
            missing = [pieces[k] for k in new.tolist()]
            self._learn(dict.fromkeys(missing))
            places[new] = [known[piece] for piece in missing]
        ids, stops = np.array(self._ids), np.array(self._stops)
        self._uses += np.bincount(places, minlength=len(stops)) > 0
        lengths = np.diff(stops, prepend=0)[places]
        ids = ids[_ranges(stops[places] - lengths, lengths)]
        ends = np.cumsum(lengths)[places == 0]
        plain = plain.to_numpy(zero_copy_only=False)
        starts, sizes = np.empty((2, len(words)), np.int64)
        order = np.r_[plain.nonzero()[0], (~plain).nonzero()[0]]
        sizes[order] = np.diff(ends, prepend=0)
        starts[order] = ends - sizes[order]
        if len(known) > REMEMBERED or len(self._ids) > LONG_PIECE * REMEMBERED:
            self._forget()
        return ids, starts, sizes

    def ids(self, texts: pa.Array, closing: tuple[int, ...] = ()) -> pa.Array:
        """Ids of each text as little-endian unsigned 16-bit numbers, ``closing`` after them."""
        texts = pc.fill_null(texts, "")
        # These part words for Arrow or for the tokenizer, not for both.
        texts = pc.replace_substring_regex(texts, r"[\x{85}\x{1680}\x{2028}\x{2029}]", " ")
        parts = pc.utf8_split_whitespace(texts)
        coded = parts.flatten().dictionary_encode()
        words, code = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        bounds = parts.offsets.to_numpy().astype(np.int64)
        bounds -= bounds[0]
        # Some take the coder's way and follow as words of their own: words that may hold the
        # names of special ids, and whole texts.
        named = pc.match_substring(words, "<|")
        (special,) = named.to_numpy(zero_copy_only=False).nonzero()
        odd = pc.match_substring_regex(texts, r"[\x1c-\x1f]")
        (whole,) = odd.to_numpy(zero_copy_only=False).nonzero()
        own = [self.coder._encode_chunk(words[k].as_py()) for k in special.tolist()]
        own += [self.coder.encode(texts[k].as_py()) for k in whole.tolist()]
        own += [[], list(closing)]
        ids, starts, sizes = self._of_words(pc.if_else(named, "", words) if len(special) else words)
        more = np.array([len(x) for x in own])
        starts = np.r_[starts, len(ids) + np.cumsum(more) - more]
        sizes = np.r_[sizes, more]
        ids = np.concatenate([ids, *(np.array(x, np.uint16) for x in own)])
        if len(special):
            place = np.arange(len(words))
            place[special] = len(words) + np.arange(len(special))
            code = place[code]
        empty, last = len(sizes) - 2, len(sizes) - 1
        for k, text in enumerate(whole.tolist(), len(words) + len(special)):
            code[bounds[text] : bounds[text + 1]] = empty
            code[bounds[text]] = k
        code = np.insert(code, bounds[1:], last)
        ends = np.cumsum(sizes[code])[bounds[1:] + np.arange(len(texts))]
        flat = []
        for start in range(0, len(code), 1 << 17):
            some = code[start : start + (1 << 17)]
            flat.append(ids[_ranges(starts[some], sizes[some])])
        data = pa.py_buffer(np.concatenate([ids[:0], *flat]).astype("<u2"))
        offsets = pa.array(np.r_[0, 2 * ends], pa.int32())
        return pa.Array.from_buffers(pa.binary(), len(texts), [None, offsets.buffers()[1], data])


@functools.lru_cache(maxsize=2)
def _words(path: str | None) -> Words:
    return Words(path)


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows that follow one another, of about ``TEXT_BYTES`` of text together."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy()
    part = np.cumsum(sizes, dtype=np.int64) // TEXT_BYTES
    starts = np.flatnonzero(np.diff(part, prepend=-1)).tolist()
    for start, stop in pairwise([*starts, batch.num_rows]):
        yield batch.slice(start, stop - start)


def tokenized(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Ids of each document as little-endian unsigned 16-bit numbers, the closing id last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _words(path)
        for batch in (part for whole in batches for part in _slices(whole)):
            ids = coder.ids(batch.column("text"), (CLOSING_ID,))
            n = pc.divide(pc.binary_length(ids).cast(pa.int64()), 2)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids, n], ["doc_id", "ids", "n"])

    return docs.select("doc_id", "text").mapInArrow(run, _TOKENS)


def _counted(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different ids of a document in order, and how often each occurs."""
    ids = np.sort(ids)
    (new,) = (ids[1:] != ids[:-1]).nonzero()
    edges = np.zeros(len(new) + 2, np.int64)
    edges[1:-1], edges[-1] = new + 1, len(ids)
    return ids[edges[:-1]], edges[1:] - edges[:-1]


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of the task per id, and under -1 their number, under -2 their ids in all."""
    counts = np.zeros(1 << 16, np.int64)
    docs = tokens = 0
    for batch in batches:
        for raw in batch.column("ids"):
            ids = np.frombuffer(raw.as_buffer(), "<u2")
            counts[_counted(ids)[0]] += 1
            docs, tokens = docs + 1, tokens + len(ids)
    (seen,) = counts.nonzero()
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(np.r_[seen, -1, -2], pa.int64()),
            pa.array(np.r_[counts[seen], docs, tokens], pa.int64()),
        ],
        ["id", "n"],
    )


class Shard:
    """The inverted index of some documents, and the order in which they are packed."""

    def __init__(self, docs: list[tuple[int, np.ndarray]], weight: np.ndarray, mean: float):
        self.docs = docs
        self.queries, impact = [], []
        for _, ids in docs:
            term, tf = _counted(ids)
            norm = K1 * (1 - B + B * len(ids) / mean)
            score = weight[term] * tf * (K1 + 1) / (tf + norm)
            impact.append(score.astype(np.float32))
            self.queries.append(term)
        sizes = [len(q) for q in self.queries]
        owners = np.repeat(np.arange(len(docs), dtype=np.int32), sizes)
        self.unused = np.ones(len(docs), bool)
        self.next = 0
        self._index(np.concatenate(self.queries), owners, np.concatenate(impact))

    def _index(self, terms: np.ndarray, owners: np.ndarray, impact: np.ndarray) -> None:
        """Postings by term: the documents that hold it, in order, and what it adds to each.

        Terms that an eighth of the unused documents hold have them as a row of numbers for
        all documents, which is read faster and takes at most eight times the postings.
        """
        self.held = int(self.unused.sum())
        counts = np.bincount(terms, minlength=1 << 16)
        frequent = 8 * counts > self.held
        self.row = np.where(frequent, np.cumsum(frequent) - 1, -1)
        self.rows = np.zeros((int(frequent.sum()), len(self.docs)), np.float32)
        dense = frequent[terms]
        self.rows[self.row[terms[dense]], owners[dense]] = impact[dense]
        self.all = terms, owners, impact
        terms, owners, impact = terms[~dense], owners[~dense], impact[~dense]
        by_term = np.argsort(terms, kind="stable")
        self.owners, self.impact = owners[by_term], impact[by_term].astype(np.float64)
        self.ends = np.cumsum(np.bincount(terms, minlength=1 << 16))

    def neighbours(self, seed: int) -> np.ndarray:
        """Unused documents that share a term with the seed, best first; all its terms count.

        Only the postings of the seed's terms are read. Once half of the documents are used,
        the postings are made anew without them.
        """
        left = int(self.unused.sum())
        if 2 * left < self.held:
            still = self.unused[self.all[1]]
            self._index(*[column[still] for column in self.all])
        if not left:
            return np.zeros(0, np.int64)
        asked = self.queries[seed].astype(np.intp)
        row = self.row[asked]
        wanted = np.zeros(len(self.rows), np.float32)
        wanted[row[row >= 0]] = 1
        scores = (wanted @ self.rows).astype(np.float64)
        asked = asked[row < 0]
        stops = self.ends[asked]
        starts = np.where(asked > 0, self.ends[asked - 1], 0)
        places = _ranges(starts, stops - starts)
        if len(places):
            scores += np.bincount(
                self.owners[places], weights=self.impact[places], minlength=len(self.docs)
            )
        (found,) = (self.unused & (scores > 0)).nonzero()
        return found[np.argsort(-scores[found], kind="stable")]

    def order(self) -> Iterator[int]:
        """Documents in packing order; a window's neighbours are those of its seed."""
        filled, seed, queue = 0, -1, iter(())
        for _ in range(len(self.docs)):
            k = next((int(q) for q in queue if self.unused[q]), -1)
            if k < 0:
                while not self.unused[self.next]:
                    self.next += 1
                k = self.next
            self.unused[k] = False
            yield k
            filled += len(self.docs[k][1])
            if filled >= WINDOW or seed < 0:
                # the part that runs over, or the first document, seeds this window
                filled, seed = filled % WINDOW, k
                queue = iter(self.neighbours(k))


def _cuts(total: int) -> list[int]:
    """Lengths of the sequences of so many ids: full windows, then powers of two."""
    full, rest = divmod(total, WINDOW)
    return [WINDOW] * full + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def _packed(first: int, docs: list, weight: np.ndarray, mean: float) -> Iterator[pa.RecordBatch]:
    docs.sort(key=lambda d: (d[0] is None, d[0] or 0))
    index = Shard(docs, weight, mean)
    cuts = _cuts(sum(len(ids) for _, ids in docs))
    sequence, room, offset, out = 0, cuts[0], 0, []
    for k in index.order():
        ident, ids = docs[k]
        start = 0
        while start < len(ids):
            length = min(room - offset, len(ids) - start)
            piece = ids[start : start + length].astype("<u4").tobytes()
            where = first + sequence
            out.append((ident, start, length, zlib.crc32(piece), len(ids), where, offset))
            start, offset = start + length, offset + length
            if offset == room and sequence + 1 < len(cuts):
                sequence, offset = sequence + 1, 0
                room = cuts[sequence]
    names = [c.split()[0] for c in _PIECES.split(", ")]
    yield pa.RecordBatch.from_arrays(
        [pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names
    )


def _keys(idents: np.ndarray, texts: list[np.ndarray], weight: np.ndarray, mean: float):
    """Signed 64-bit keys that lie close for documents with the same heaviest terms.

    The three heaviest terms of a document, the heaviest first, then 16 bits of its id, by
    which copies of one text can part.
    """
    out = np.full((len(texts), 3), (1 << 16) - 1, np.uint64)
    for k, ids in enumerate(texts):
        term, tf = _counted(ids)
        score = weight[term] * tf / (tf + K1 * (1 - B + B * len(ids) / mean))
        best = np.lexsort((term, -score))[:3]
        best = best[score[best] > 0]
        out[k, : len(best)] = term[best]
    mixed = (idents.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)
    key = mixed
    for k, shift in enumerate((48, 32, 16)):
        key = key | (out[:, k] << np.uint64(shift))
    return (key ^ np.uint64(1 << 63)).view(np.int64)


def _keyed(weight, mean: float, bounds):
    """A function that adds keys and, given their bounds, shards; weight and bounds are broadcast."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                texts = [np.frombuffer(x.as_buffer(), "<u2") for x in batch.column("ids")]
                idents = pc.fill_null(batch.column("doc_id"), -1).to_numpy()
                key = _keys(idents, texts, weight.value, mean)
                cuts = np.zeros(0, np.int64) if bounds is None else bounds.value
                shard = np.searchsorted(cuts, key, "right")
                columns = [pa.array(shard, pa.int64()), pa.array(key), *map(batch.column, _DEALT)]
                yield pa.RecordBatch.from_arrays(columns, ["shard", "key", *_DEALT])

    return run


def pack(docs: DataFrame, path: str | None = None) -> DataFrame:
    """The pieces of all documents and where each lies."""
    ids = staged(tokenized(docs, path), "tokens")
    counted = ids.select("ids").mapInArrow(_frequencies, "id bigint, n bigint")
    found = counted.groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    table = dict(zip(found["id"].tolist(), found["n"].tolist(), strict=True))
    n_docs, n_tokens = table.pop(-1, 0), table.pop(-2, 0)
    weight = np.zeros(1 << 16, np.float32)
    for k, n in table.items():
        weight[k] = np.log(1 + (n_docs - n + 0.5) / (n + 0.5))
    mean = n_tokens / max(n_docs, 1)
    shards = max(1, -(-n_tokens // SHARD_TOKENS))
    spark = docs.sparkSession.sparkContext
    broadcast = spark.broadcast(weight)  # 256 KiB
    dealt = ids.select(F.lit(0).cast("bigint").alias("shard"), F.lit(0).cast("bigint").alias("key"), *_DEALT)
    if shards > 1:
        # Terms of fewer documents than a shard holds would leave the rest of it to chance.
        common = np.zeros(1 << 16, bool)
        common[[k for k, n in table.items() if n * shards >= n_docs]] = True
        near = spark.broadcast(np.where(common, weight, 0))
        share = min(1.0, shards * DEALT_BY / n_docs)
        some = ids.where(F.pmod(F.xxhash64("doc_id", "n"), F.lit(1_000_003)) < int(share * 1_000_003))
        keys = some.mapInArrow(_keyed(near, mean, None), _KEYED).select("key", "n").toPandas()
        keys = keys.sort_values(["key", "n"])
        filled = keys["n"].cumsum().to_numpy()
        at = np.searchsorted(filled, filled[-1:] * np.arange(1, shards) / shards)
        bounds = spark.broadcast(keys["key"].to_numpy()[at])
        dealt = ids.mapInArrow(_keyed(near, mean, bounds), _KEYED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held, size, first = None, [], 0, 0
        for batch in batches:
            columns = (batch.column(c) for c in ("shard", "doc_id", "ids"))
            for s, ident, raw in zip(*columns, strict=True):
                s = s.as_py()
                if held and (s != shard or size >= 2 * SHARD_TOKENS):
                    yield from _packed((shard << 32) + first, held, broadcast.value, mean)
                    first = first + len(_cuts(size)) if s == shard else 0
                    held, size = [], 0
                shard = s
                held.append((ident.as_py(), np.frombuffer(raw.as_py(), "<u2")))
                size += len(held[-1][1])
        if held:
            yield from _packed((shard << 32) + first, held, broadcast.value, mean)

    placed = dealt.repartition("shard").sortWithinPartitions("shard", "key", "doc_id", "n")
    return placed.select("shard", "doc_id", "ids").mapInArrow(run, _PIECES)
