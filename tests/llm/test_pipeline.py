"""The stages, one after another, on the smallest tables."""

import re
import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
from stratiform.llm import quality_rules
from stratiform.llm.common import read, staged

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = read(spark, SF, "documents")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(staged(stage(spark, out[-1], SF), name))
    return out


def ids(df):
    return {r[0] for r in df.select("doc_id").collect()}


def test_stages_keep_columns_and_narrow(steps):
    for before, after in zip(steps, steps[1:-1], strict=False):
        assert after.columns == before.columns
        assert ids(after) <= ids(before)


def test_quality_keeps_what_no_rule_rejects(steps):
    rows = quality_rules.judged(quality_rules.ledger(steps[0]))
    assert ids(steps[1]) == ids(rows.where("kept"))


def test_exact_keeps_the_first_of_equal_texts(steps):
    first = {}
    for r in steps[1].orderBy("doc_id").collect():
        first.setdefault(" ".join((r["text"] or "").split()), r["doc_id"])
    assert ids(steps[2]) == set(first.values())


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    if not words:
        return set()
    return {tuple(words[k : k + 5]) for k in range(max(len(words) - 4, 1))}


def test_near_keeps_the_first_of_each_group_of_near_copies(steps):
    rows = sorted((r["doc_id"], r["text"]) for r in steps[2].collect())
    root = {ident: ident for ident, _ in rows}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    sets = [(ident, shingles(text)) for ident, text in rows]
    for k, (a, x) in enumerate(sets):
        for b, y in sets[k + 1 :]:
            both = len(x & y)
            if both and 100 * both >= 80 * (len(x) + len(y) - both):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    assert ids(steps[3]) == {ident for ident in root if find(ident) == ident}


def test_passages_go_where_they_start_twice(steps):
    size = corpus_pipeline.PASSAGE
    raw = {r["doc_id"]: (r["text"] or "").encode() for r in steps[3].collect()}
    starts = Counter(t[k : k + size] for t in raw.values() for k in range(len(t) - size + 1))
    after = {r["doc_id"]: r["text"] for r in steps[4].collect()}
    assert set(after) == set(raw) and any(n > 1 for n in starts.values())
    for ident, t in raw.items():
        kept = bytearray(b"\1" * len(t))
        for k in range(len(t) - size + 1):
            if starts[t[k : k + size]] > 1:
                kept[k : k + size] = bytes(size)
        rest = bytes(b for b, keep in zip(t, kept) if keep)
        assert after[ident] == rest.decode("utf-8", "ignore")


def test_packing_has_every_token_of_the_texts(steps):
    import public_tokenizers
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = {}
    for r in steps[5].collect():
        pieces.setdefault(r["doc_id"], []).append((r["start"], r["length"], r["ids_crc32"]))
    for r in steps[4].collect():
        tokens = [*coder.encode(r["text"], add_special_tokens=False).ids, 1]
        at = 0
        for start, length, crc in sorted(pieces[r["doc_id"]]):
            assert start == at
            assert zlib.crc32(np.array(tokens[start : start + length], "<u4").tobytes()) == crc
            at += length
        assert at == len(tokens)


def test_rows_without_an_id_and_ids_with_two_texts_stay(spark):
    clean = [" ".join(f"w{n}{k}" for k in range(120)) for n in range(3)]
    rows = [(None, clean[0], "en", "s", 1), (7, clean[1], "en", "s", 1), (7, clean[2], "en", "s", 1)]
    rows += [rows[1], (8, clean[1].replace(" ", "  "), "en", "s", 1)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    docs = spark.createDataFrame(rows, schema).repartition(3)
    out = staged(corpus_pipeline.exact(spark, docs, SF), "odd-exact")
    assert sorted(map(str, out.collect())) == sorted(map(str, spark.createDataFrame(rows[:3], schema).collect()))
    near = corpus_pipeline.near(spark, out, SF)
    assert {r["text"] for r in near.collect()} == set(clean)


def test_passages_leave_whole_characters(steps):
    for r in steps[4].collect():
        assert "�" not in r["text"] and r["n_chars"] == len(r["text"])
    assert ids(steps[4]) == ids(steps[3])


def test_packing_packs_every_document(steps):
    assert ids(steps[5]) == ids(steps[4])
