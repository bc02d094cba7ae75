"""Exact dedup by owners in Patricia tries.

Each map task first inserts its texts into a trie of its own and passes on one row per
different text, so a text that fills a third of the table reaches the shuffle once per
task. Rows are then dealt by length and content hash; each partition inserts the full
byte strings into a compressed radix trie whose terminal nodes hold the smallest id and
the number of rows. A trie that outgrows its memory writes its largest subtree to a
scratch file of the task and takes it up again, as a trie of its own, at the end.

Texts are equal when identical after each run of white space becomes one space; null is
an empty text. Repeated rows count in ``group_size``, and all rows with the smallest id
count as kept. A row without an id is never kept; ``keep_id`` is null where no row of a
group has one. Other columns are not read. An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import struct
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiform.llm.common import WHITE_SPACE

SPILL_BYTES = 96 * 1024**2
BATCH_BYTES = 8 * 1024**2
_HEAD = struct.Struct("<qqq")


class _Node:
    __slots__ = ("children", "count", "label", "least")

    def __init__(self, label: bytes):
        self.label = label
        self.children: dict[int, _Node | _Spilled] = {}
        self.count = 0
        self.least = 0

    def own(self, ident: int, count: int) -> None:
        self.least = ident if not self.count else min(self.least, ident)
        self.count += count


class _Spilled:
    """A subtree on disk: records of rest of key, id and count, in no order."""

    __slots__ = ("file",)

    def __init__(self):
        self.file = tempfile.TemporaryFile()

    def add(self, rest: bytes, ident: int, count: int) -> None:
        self.file.write(_HEAD.pack(len(rest), ident, count))
        self.file.write(rest)

    def records(self) -> Iterator[tuple[bytes, int, int]]:
        self.file.seek(0)
        while head := self.file.read(_HEAD.size):
            size, ident, count = _HEAD.unpack(head)
            yield self.file.read(size), ident, count
        self.file.close()


def _shared_prefix(a: bytes, key: bytes, at: int) -> int:
    """How many bytes of ``a`` also stand in ``key`` from ``at`` on."""
    low, high = 0, min(len(a), len(key) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == key[at + low : at + middle]:
            low = middle
        else:
            high = middle - 1
    return low


class PatriciaTrie:
    """Byte strings with their smallest id and number of rows, within a bound of memory."""

    def __init__(self, spill_bytes: int = SPILL_BYTES):
        self.root = _Node(b"")
        self.spill_bytes = spill_bytes
        self.size = 0

    def insert(self, key: bytes, ident: int, count: int = 1) -> None:
        node, at = self.root, 0
        while at < len(key):
            child = node.children.get(key[at])
            if child is None:
                leaf = _Node(key[at:])
                leaf.own(ident, count)
                node.children[key[at]] = leaf
                self.size += len(leaf.label) + 200
                if self.size > self.spill_bytes:
                    self._spill()
                return
            if isinstance(child, _Spilled):
                child.add(key[at:], ident, count)
                return
            if not key.startswith(child.label, at):
                cut = _shared_prefix(child.label, key, at)
                upper = _Node(child.label[:cut])
                child.label = child.label[cut:]
                upper.children[child.label[0]] = child
                node.children[key[at]] = upper
                self.size += 200
                child = upper
            at += len(child.label)
            node = child
        node.own(ident, count)

    @staticmethod
    def _walk(node: _Node, prefix: bytes) -> Iterator[tuple[bytes, _Node | _Spilled]]:
        stack: list[tuple[bytes, _Node | _Spilled]] = [(prefix, node)]
        while stack:
            key, here = stack.pop()
            yield key, here
            if isinstance(here, _Node):
                for first, child in here.children.items():
                    label = child.label if isinstance(child, _Node) else b""
                    stack.append((key + label, child))

    def _spill(self) -> None:
        """Write the largest subtree below the first branching to a file."""
        node = self.root
        while len(node.children) == 1:
            (only,) = node.children.values()
            if isinstance(only, _Spilled):
                return
            node = only
        sizes = {
            first: sum(len(n.label) + 200 for _, n in self._walk(c, b"") if isinstance(n, _Node))
            for first, c in node.children.items()
            if isinstance(c, _Node)
        }
        if not sizes:
            return
        first = max(sizes, key=sizes.get)
        subtree = node.children[first]
        out = _Spilled()
        for key, here in self._walk(subtree, subtree.label):
            if isinstance(here, _Spilled):
                for rest, ident, count in here.records():
                    out.add(key + rest, ident, count)
            elif here.count:
                out.add(key, here.least, here.count)
        node.children[first] = out
        self.size -= sizes[first]

    def owners(self) -> Iterator[tuple[bytes, int, int]]:
        """Each different key once, with its smallest id and its number of rows."""
        for key, here in self._walk(self.root, b""):
            if isinstance(here, _Spilled):
                below = PatriciaTrie(self.spill_bytes)
                for rest, ident, count in here.records():
                    below.insert(rest, ident, count)
                for rest, ident, count in below.owners():
                    yield key + rest, ident, count
            elif here.count:
                yield key, here.least, here.count


_NO_ID = (1 << 63) - 1  # after every id
_KEYED = ("doc_id", "content")
_COMBINED = "n_bytes bigint, content_hash bigint, content binary, doc_id bigint, n bigint"
_OWNERS = "n_bytes bigint, text_sha256 string, keep_id bigint, group_size bigint"


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per different text of the task; a full trie is passed on and begun anew."""
    trie = PatriciaTrie(1 << 62)

    def rows():
        out, size = [], 0
        for key, ident, count in trie.owners():
            code = int.from_bytes(hashlib.blake2b(key, digest_size=8).digest(), signed=True)
            out.append((len(key), code, key, ident, count))
            size += len(key)
            if size > BATCH_BYTES:
                yield _batch(out, _COMBINED_ARROW)
                out, size = [], 0
        if out:
            yield _batch(out, _COMBINED_ARROW)

    for batch in batches:
        for ident, text in zip(*(batch.column(c).to_pylist() for c in _KEYED), strict=True):
            trie.insert(text, ident)
            if trie.size > SPILL_BYTES:
                yield from rows()
                trie = PatriciaTrie(1 << 62)
    yield from rows()


def _own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    trie = PatriciaTrie()
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("content", "doc_id", "n"))
        for text, ident, count in zip(*columns, strict=True):
            trie.insert(text, ident, count)
    out = []
    for key, ident, count in trie.owners():
        least = None if ident == _NO_ID else ident
        out.append((len(key), hashlib.sha256(key).hexdigest(), least, count))
        if len(out) == 20_000:
            yield _batch(out, _OWNERS_ARROW)
            out = []
    if out:
        yield _batch(out, _OWNERS_ARROW)


_COMBINED_ARROW = pa.schema(
    [
        ("n_bytes", pa.int64()),
        ("content_hash", pa.int64()),
        ("content", pa.binary()),
        ("doc_id", pa.int64()),
        ("n", pa.int64()),
    ]
)
_OWNERS_ARROW = pa.schema(
    [
        ("n_bytes", pa.int64()),
        ("text_sha256", pa.string()),
        ("keep_id", pa.int64()),
        ("group_size", pa.int64()),
    ]
)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def _content(docs: DataFrame) -> DataFrame:
    plain = F.regexp_replace(F.coalesce("text", F.lit("")), WHITE_SPACE, " ")
    return docs.select("doc_id", plain.cast("binary").alias("content"))


def owners(docs: DataFrame) -> DataFrame:
    """One row per different text: its length and digest, smallest id and number of rows."""
    keyed = _content(docs).withColumn("doc_id", F.coalesce("doc_id", F.lit(_NO_ID))).select(*_KEYED)
    dealt = keyed.mapInArrow(_combine, _COMBINED).repartition("n_bytes", "content_hash")
    return dealt.mapInArrow(_own, _OWNERS)


def exact_dedup(docs: DataFrame) -> DataFrame:
    """Each document with the one that stays for it.

    A document finds its owner by length and digest, small columns only. A hot text is a
    hot key of that join on the documents' side alone, which adaptive execution splits.
    """
    digests = _content(docs).select(
        "doc_id",
        F.octet_length("content").cast("bigint").alias("n_bytes"),
        F.sha2("content", 256).alias("text_sha256"),
    )
    return digests.join(owners(docs), ["n_bytes", "text_sha256"]).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.coalesce(F.col("doc_id") == F.col("keep_id"), F.lit(False)).alias("kept"),
        "text_sha256",
    )
