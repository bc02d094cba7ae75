"""Each operator against a plain version, and on rows that are odd."""

import hashlib
import itertools
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from stratiform.llm import (
    bpe,
    exact_dedup,
    graph,
    html_extraction,
    jaccard_join,
    language_id,
    packing,
    quality_classifier,
    quality_rules,
    suffix_dedup,
    url_filters,
)

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id bigint, text string, lang string, n_words string, kept string, key string"


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(7)
    names = [f"w{k}" for k in range(400)]
    base = [" ".join(rng.choice(names, 150)) for _ in range(8)]
    near = []
    for text in base[:4]:
        for edits in (1, 2, 4, 9):
            own = text.split()
            for k in rng.choice(len(own), edits, replace=False):
                own[k] = f"x{k}"
            near.append(" ".join(own))
    passage = " ".join(rng.choice(names, 120))
    odd = ["", None, " \t\n", "a", "a b", "A B", "é" * 900, "x" * 1200, "a\x1cb <|endoftext|>\n\n- a"]
    shared = [f"{base[5][:300]} {passage} {base[6][:200]}", f"other start {passage} end"]
    return [*base, *near, *odd, *shared, base[0], base[0].replace(" ", "  "), base[1] * 30]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(k, t, "en", "n", "k", "c") for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS).repartition(3, "doc_id")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def by_id(df):
    return {row["doc_id"]: row for row in df.collect()}


def test_exact_dedup(docs, empty, texts):
    groups = defaultdict(list)
    plain = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for t in texts]
    for k, t in enumerate(plain):
        groups[t].append(k)
    found = by_id(exact_dedup.exact_dedup(docs))
    assert len(found) == len(texts)
    for k, t in enumerate(plain):
        row = found[k]
        assert (row["keep_id"], row["group_size"]) == (groups[t][0], len(groups[t]))
        assert row["kept"] == (groups[t][0] == k)
        assert row["text_sha256"] == hashlib.sha256(t.encode()).hexdigest()
    assert exact_dedup.exact_dedup(empty).count() == 0


def test_exact_dedup_without_ids(spark):
    rows = spark.createDataFrame([(None, "a"), (3, "a"), (3, "a"), (None, "b")], "doc_id bigint, text string")
    found = Counter(tuple(r)[:4] for r in exact_dedup.exact_dedup(rows).collect())
    expected = {(None, 3, 3, False): 1, (3, 3, 3, True): 2, (None, None, 1, False): 1}
    assert found == expected


@pytest.mark.parametrize("spill", [1, 900, 1 << 30])
def test_trie_spills_by_subtree(spill):
    keys = [b"", b"a", b"abc", b"abd", b"b" * 50, b"a", b"abcd", b"b" * 49 + b"c", b"zz", b"z"] * 3
    trie = exact_dedup.PatriciaTrie(spill)
    for k, key in enumerate(keys):
        trie.insert(key, k)
    found = {key: (least, n) for key, least, n in trie.owners()}
    assert found == {key: (keys.index(key), keys.count(key)) for key in set(keys)}


@pytest.mark.parametrize("percent, width, limit", [(90, 3, 10**6), (80, 5, 10**6), (90, 3, 200)])
def test_jaccard_join(docs, empty, texts, percent, width, limit):
    sets = []
    for t in texts:
        w = WORD.findall((t or "").lower() if (t or "").isascii() else (t or ""))
        shingles = {tuple(w[i : i + width]) for i in range(max(len(w) - width + 1, 1))}
        sets.append(shingles if w else set())
    root = list(range(len(texts)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in itertools.combinations(range(len(texts)), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            first, second = sorted((find(a), find(b)))
            root[second] = first
    found = by_id(jaccard_join.jaccard_join(docs, percent, width, limit))
    assert {k: (r["n_shingles"], r["component_id"]) for k, r in found.items()} == {
        k: (len(s), find(k)) for k, s in enumerate(sets)
    }
    assert jaccard_join.jaccard_join(empty).count() == 0


def chained(length):
    """A shuffled chain, a key with many nodes, a pair, a node alone, and each node's root."""
    rng = np.random.default_rng(5)
    names = rng.choice(10**6, length, replace=False).tolist()
    members = [(k, n) for k in range(length - 1) for n in names[k : k + 2]]
    hot = list(range(10**7 + 1, 10**7 + 300))
    members += [(-1, n) for n in hot] + [(-2, 10**8), (-2, 10**8 - 1), (-3, 10**9)]
    expected = dict.fromkeys(names, min(names)) | dict.fromkeys(hot, hot[0])
    return members, expected | {10**8: 10**8 - 1, 10**8 - 1: 10**8 - 1, 10**9: 10**9}


@pytest.mark.parametrize("rows", [graph.TASK_ROWS, 100, 0])
def test_components(spark, rows):
    members, expected = chained(40)
    found = graph.components(spark.createDataFrame(members, "key bigint, node bigint"), rows)
    assert sorted(map(tuple, found.collect())) == sorted(expected.items())
    assert graph.components(spark.createDataFrame([], "key bigint, node bigint"), rows).count() == 0


def test_components_of_a_long_chain_take_few_jobs(spark):
    members, expected = chained(2000)
    members = spark.createDataFrame(members, "key bigint, node bigint")
    spark.sparkContext.setJobGroup("long-chain", "components")
    try:
        found = graph.components(members)
    finally:
        for name in ("spark.jobGroup.id", "spark.job.description"):
            spark.sparkContext.setLocalProperty(name, None)
    assert sorted(map(tuple, found.collect())) == sorted(expected.items())
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("long-chain")
    assert 0 < len(jobs) <= 10


def test_region_joins_like_all_pairs():
    rng = np.random.default_rng(3)
    bases = [rng.integers(0, 10**9, 60) for _ in range(12)]
    sets = [
        np.unique(np.where(rng.random(60) < share, rng.integers(0, 10**9, 60), b))
        for b in bases
        for share in (0.0, 0.02, 0.04, 0.06, 0.1, 0.3)
    ]
    region = jaccard_join.Region(sets, 90)
    region.join()
    got = region.links.roots(np.arange(len(sets)))
    links = jaccard_join.Links(len(sets))
    for a, b in itertools.combinations(range(len(sets)), 2):
        both = len(np.intersect1d(sets[a], sets[b]))
        if 100 * both >= 90 * (len(sets[a]) + len(sets[b]) - both):
            links.join(a, b)
    assert got.tolist() == links.roots(np.arange(len(sets))).tolist()


@pytest.mark.parametrize(
    "hot, size", [(suffix_dedup.HOT, suffix_dedup.LENGTH), (1, suffix_dedup.LENGTH), (1, 200), (50, 62)]
)
def test_suffix_dedup(docs, empty, texts, hot, size):
    raw = [(t or "").encode() for t in texts]
    starts = Counter(r[k : k + size] for r in raw for k in range(len(r) - size + 1))
    found = by_id(suffix_dedup.suffix_dedup(docs, hot, length=size))
    for k, r in enumerate(raw):
        gone = np.zeros(len(r), bool)
        for s in range(len(r) - size + 1):
            if starts[r[s : s + size]] > 1:
                gone[s : s + size] = True
        kept = bytes(b for b, g in zip(r, gone, strict=True) if not g)
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        row = found[k]
        assert (row["n_bytes"], row["n_removed"], row["n_spans"]) == (len(r), gone.sum(), spans)
        assert row["kept_sha256"] == hashlib.sha256(kept).hexdigest()
    assert sum(r["n_removed"] for r in found.values()) > 3000
    assert suffix_dedup.suffix_dedup(empty).count() == 0


def test_long_texts_have_the_same_seeds():
    data = np.frombuffer(np.random.default_rng(1).bytes(5000), np.uint8)
    whole = suffix_dedup.seeds(data, np.array([0, len(data)]))
    parts = suffix_dedup._long_seeds(data, np.array([0, len(data)]))
    assert all((a == b).all() for a, b in zip(whole, parts, strict=True))


def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(bpe.VOCABULARY))


def test_bpe_is_the_librarys(docs, empty, texts):
    own = tokenizer()
    found = by_id(bpe.bpe(docs, texts=True))
    for k, t in enumerate(texts):
        ids = own.encode(t or "", add_special_tokens=False).ids
        assert found[k]["ids"] == " ".join(map(str, ids))
        assert found[k]["decoded"] == own.decode(ids, skip_special_tokens=False)
    assert bpe.bpe(empty).count() == 0


def test_packing_keeps_every_id(docs, empty, texts):
    own = tokenizer()
    ids = [[*own.encode(t or "", add_special_tokens=False).ids, 1] for t in texts]
    rows = packing.pack(docs).collect()
    pieces = defaultdict(list)
    for r in rows:
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
        assert r["doc_tokens"] == len(ids[r["doc_id"]])
        pieces[r["doc_id"]].append((r["start"], r["length"]))
    for k, own_ids in enumerate(ids):
        at = 0
        for start, length in sorted(pieces[k]):
            assert start == at and length > 0
            at += length
        assert at == len(own_ids)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.WINDOW and at & (at - 1) == 0  # no padding
    assert packing.pack(empty).count() == 0


def test_packing_deals_related_documents_together(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_TOKENS", 4000)
    rng = np.random.default_rng(11)
    topics, rest = ("water", "music", "law", "horse"), ["the", "of", "and", "in", "to"]
    rows = [(k, " ".join([*rng.permutation(rest * 12), *[topics[k % 4]] * 6])) for k in range(400)]
    found = packing.pack(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    shards, sizes = defaultdict(Counter), Counter()
    for r in found:
        shards[r["sequence_id"] >> 32][r["doc_id"] % 4] += 1
        sizes[r["sequence_id"] >> 32] += r["length"]
    assert len(shards) > 4 and max(sizes.values()) <= 2 * 4000 + 200
    own = sum(max(topic.values()) for topic in shards.values())
    assert own > 0.7 * sum(sum(topic.values()) for topic in shards.values())


def test_packing_has_the_ids_of_every_byte_and_takes_null_ids(spark):
    texts = [f"a{chr(k)}b" for k in range(256)] + ["\x07", "\x00\x7f \x1b[0m", None]
    rows = [(None if k % 90 == 0 else k, t) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    found = packing.pack(df).collect()
    coder, wanted = tokenizer(), Counter()
    for ident, text in rows:
        ids = coder.encode(text or "", add_special_tokens=False).ids + [packing.CLOSING_ID]
        wanted[ident, len(ids)] += 1
    whole = Counter((r.doc_id, r.doc_tokens) for r in found if r.start == 0)
    assert whole == wanted
    for r in found:
        if r.doc_id is not None and r.start == 0 and r.length == r.doc_tokens:
            ids = coder.encode(texts[r.doc_id] or "", add_special_tokens=False).ids + [1]
            assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes()), texts[r.doc_id]


def test_packing_merges_pieces_in_use_once(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 60)
    words, merged, own = packing.Words(), Counter(), tokenizer()
    model = words._model

    class Counting:
        def tokenize(self, piece):
            merged[piece] += 1
            return model.tokenize(piece)

    words._model = Counting()
    rng = np.random.default_rng(9)
    for _ in range(8):
        texts = ["often, USED (often)", *("".join(rng.choice([*"abcdefgh"], 12)) for _ in range(40))]
        for text, ids in zip(texts, words.ids(pa.array(texts)), strict=True):
            got = np.frombuffer(ids.as_py() if isinstance(ids, pa.Scalar) else ids, "<u2")
            assert got.tolist() == own.encode(text, add_special_tokens=False).ids
    words.ids(pa.array(["".join(rng.choice([*"abcdefgh"], 9000))]))
    assert len(words._ids) <= packing.LONG_PIECE * 60  # long pieces are forgotten
    assert merged["often"] == merged["used"] == 1
    assert sum(merged.values()) > 300


def test_packing_ids_of_odd_words_are_those_of_the_library():
    own = tokenizer()
    odd = ["it's 'TIS we'll x'saa .'s ''re", "a1b22 3.14 ... </w>", "<|endoftext|>a <|x <|ENDOFTEXT|>"]
    odd += ["É E\u0301 H\u0331 \u212a \u0130 ΣΑΣ ß ﬁ", "a\xa0b\u2028c\u1680d\x85e\u3000", " \n\t", "", None, "漢字 가"]
    odd += ["plain words, and more", "x\x1cy <|endoftext|> z", "x\x1fy"]
    array = pa.array(["before", *odd]).slice(1)
    got = packing.Words().ids(array, (packing.CLOSING_ID,)).to_pylist()
    for text, ids in zip(odd, got, strict=True):
        wanted = [*own.encode(text or "", add_special_tokens=False).ids, packing.CLOSING_ID]
        assert np.frombuffer(ids, "<u2").tolist() == wanted, text


def test_packing_order_is_that_of_plain_bm25():
    """Each seed is followed by its best unused neighbours, as plain scores have them."""
    rng = np.random.default_rng(6)
    docs = [(k, rng.integers(0, 300, rng.integers(20, 700)).astype(np.uint16)) for k in range(120)]
    df = Counter(t for _, ids in docs for t in set(ids.tolist()))
    weight = np.zeros(1 << 16, np.float32)
    for term, n in df.items():
        weight[term] = np.log(1 + (len(docs) - n + 0.5) / (n + 0.5))
    mean = np.mean([len(ids) for _, ids in docs])

    def score(seed, other):
        tf = Counter(docs[other][1].tolist())
        norm = packing.K1 * (1 - packing.B + packing.B * len(docs[other][1]) / mean)
        shared = set(docs[seed][1].tolist()) & set(tf)
        return sum(float(weight[t]) * tf[t] * (packing.K1 + 1) / (tf[t] + norm) for t in shared)

    got = list(packing.Shard(docs, weight, mean).order())
    assert sorted(got) == list(range(len(docs)))
    unused, filled, seed = set(range(len(docs))), 0, None
    for k in got:
        if seed is not None:
            best = max(score(seed, other) for other in unused)
            assert score(seed, k) >= best - 1e-3
        unused.remove(k)
        filled += len(docs[k][1])
        if filled >= packing.WINDOW or seed is None:
            filled, seed = filled % packing.WINDOW, k


def test_packing_scores_all_terms_of_a_seed():
    seed, light = np.arange(100, 140, dtype="<u2"), np.arange(112, 140, dtype="<u2")
    other = np.arange(500, 540, dtype="<u2")
    weight = np.ones(1 << 16, np.float32)
    weight[112:140] = 0.5  # not among the twelve heaviest
    shard = packing.Shard([(0, seed), (1, other), (2, light)], weight, 40.0)
    shard.unused[0] = False
    assert shard.neighbours(0).tolist() == [2]


def test_quality_rules(docs, empty, texts):
    found = by_id(quality_rules.judged(quality_rules.ledger(docs)))
    for k, t in enumerate(texts):
        w = WORD.findall(t or "")
        windows = Counter(zip(w, w[1:], w[2:], strict=False))
        hit = {i + j for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for j in range(3)}
        lines = [x for x in (t or "").split("\n") if WORD.search(x)]
        row = found[k]
        assert (row["n_words"], row["word_chars"]) == (len(w), sum(map(len, w)))
        assert row["n_repeat_words"] == len(hit)
        assert row["n_dup_lines"] == len(lines) - len(set(lines))
        assert row["n_symbols"] == sum(c in quality_rules.SYMBOLS for c in t or "")
        assert row["base_failed"] == (len(w) < 50 or 100 * len(hit) > 50 * len(w))
        assert not (row["kept"] and row["base_failed"])
    ledger = quality_rules.ledger(docs)
    few = next(r for r in quality_rules.ablation(ledger).collect() if r["rule"] == "few_words")
    assert few["n_failed"] == sum(r["n_words"] < 50 for r in found.values())
    assert quality_rules.judged(quality_rules.ledger(empty)).count() == 0


def test_html_extraction(spark):
    page = (
        "<html><head><title>T</title><script>var a='</p>'</script></head><body>"
        "<header>Site</header><nav><a href=/>Home</a></nav><div class='cookie-notice'>Ok.</div>"
        "<article><h1>Head &amp; more</h1><p>One  <b>two</b>\n three.<p>Four, five.<!-- x -->"
        "<ul><li>six<li>seven</ul></article><aside>Side, text.</aside>"
        "<div id=comments><p>First, comment. Long, long, long.</p></div><footer>F.</footer>"
    )
    rows = [(0, "u", page), (1, None, None), (2, "u", ""), (3, "u", "just text &lt;"), (4, "u", "<p")]
    found = html_extraction.extract(
        spark.createDataFrame(rows, "page_id bigint, url string, html string")
    ).collect()
    texts = {r["page_id"]: r["text"] for r in found}
    assert texts[0] == "Head & more\nOne two three.\nFour, five.\nsix\nseven"
    assert (texts[1], texts[2], texts[3]) == ("", "", "just text <")
    assert all(r["n_chars"] == len(r["text"]) for r in found)


def test_html_extraction_keeps_all_parts_of_the_content():
    def text(words, k):
        return f"Paragraph {k}, " + "with a word, or two, " * words + "and an end."

    long, short = [text(12, k) for k in range(20)], [text(2, k) for k in range(2)]
    items = [f"Item {k}" for k in range(60)]
    p = "<p>{}</p>".format
    li, td = "<li>{}</li>".format, "<tr><td>{}</td></tr>".format
    head = "<html><body><nav><a href=/>Home</a></nav>"
    foot = "<div><a href=/a>Terms</a> <a href=/b>Imprint</a></div><footer>F.</footer></body></html>"
    body = "<div class=body>" + "".join(map(p, long)) + "</div>"
    listed = "<ul>" + "".join(map(li, items)) + "</ul>"
    table = "<table>" + "".join(map(td, items)) + "</table>"
    quote = "<blockquote>" + "".join(map(p, long)) + "</blockquote>"
    lead, end = p(short[0]), p(short[1])
    parts = f"<section><h2>A</h2>{''.join(map(p, long))}</section><section><h2>B</h2>{end}</section>"
    cases = [
        (f"<h1>Head</h1>{lead}{body}", ["Head", short[0], *long]),
        (f"<h1>Head</h1>{lead}{body}{end}", ["Head", short[0], *long, short[1]]),
        (f"<h1>Head</h1>{lead}{listed}{end}", ["Head", short[0], *items, short[1]]),
        (f"<h1>Head</h1>{lead}{table}{end}", ["Head", short[0], *items, short[1]]),
        (f"<h1>Head</h1>{lead}{quote}{end}", ["Head", short[0], *long, short[1]]),
        (f"<h1>Head</h1>{parts}", ["Head", "A", *long, "B", short[1]]),
        (f"<h1>Head</h1>{''.join(map(p, long))}<ul><li>x<li>y</ul>", ["Head", *long, "x", "y"]),
    ]
    for inner, whole in cases:
        for tag in ("article", "main", "div"):
            page = f"{head}<{tag}>{inner}</{tag}>{foot}"
            assert html_extraction.main_text(page).split("\n") == whole


LINE = "<p>" + "The quick, brown fox jumps over the lazy dog. " * 6 + "</p>"
PARAGRAPH = ("The quick, brown fox jumps over the lazy dog. " * 6).strip()


@pytest.mark.parametrize(
    "page, wanted",
    [
        (f"<div class='layout with-sidebar'><article><h1>T</h1>{LINE}</article></div>", "T|~"),
        (f"<article><div class='article-header'><h1>Title</h1></div>{LINE}</article>", "Title|~"),
        (f"<article>{LINE}<section id='related-work'><h2>Past</h2>{LINE}</section></article>", "~|Past|~"),
        (f"<article>{LINE}<p class='share-price'>The price rose, again.</p>{LINE}</article>", "~|The price rose, again.|~"),
        (f"<article title=it's><h1>T</h1>{LINE}</article><div id='x'>y</div>", "T|~"),
        (f"<article>{LINE}{LINE}</article><article class='comment'><p>Nice, very nice.</p></article>", "~|~"),
        (f"<main><article>{LINE}</article><div><article class='comment'><p>Nice.</p></article></div></main>", "~"),
        (f"<article>{LINE}</article><section><h3>3 Comments</h3><div><p>Nice, I like it, a lot.</p></div></section>", "~"),
        (f"<article>{LINE}{LINE}<h2>Comments (2)</h2><p>Nice, very nice post.</p></article>", "~|~"),
        (f"<article>{LINE}<h2>Comments on the law</h2>{LINE}</article>", "~|Comments on the law|~"),
        (f"<article>{LINE}<div data-ad>Buy this, now.</div>{LINE}</article>", "~|~"),
        (f"<article>{LINE}<div class='ad-slot'><p>Buy this, now.</p></div>{LINE}</article>", "~|~"),
        (f"<div class='page-with-sidebar'>{LINE}{LINE}<div class='sidebar'><p>Aside.</p></div></div>", "~|~"),
        (f"<div class='sidebar'>{LINE * 9}</div><article><h1>T</h1>{LINE}</article>", "T|~"),
        (f"<article>{LINE}<p title=\"a>b\" lang=en>One, two.</p>{LINE}</article>", "~|One, two.|~"),
    ],
)
def test_names_only_help_html_extraction(page, wanted):
    assert html_extraction.main_text(page) == wanted.replace("~", PARAGRAPH).replace("|", "\n")


@pytest.mark.parametrize(
    "part", ["<a ", "<a x='", "<div>", "<script>", "<!--", '<p title=">', "<", "<b a=", "<h2>Comments</h2>x"]
)
def test_hostile_pages_take_no_longer_than_others(part):
    started = time.process_time()
    html_extraction.main_text(part * (1_000_000 // len(part)))
    html_extraction.main_text(part * (1_000_000 // len(part)) + ">end")
    assert time.process_time() - started < 8


def test_odd_pages(spark, empty):
    schema = "page_id bigint, url string, html string, text string, n_chars string"
    page = f"<article><h1>é&amp;&#x41;</h1>{LINE}</article>"
    rows = [(1, "u", page, "x", "y")] * 2 + [(None, None, page, "x", "y"), (2, None, None, "x", "y"), (3, "u", "", "", "")]
    rows += [(4, "u", "<article>" + LINE * 20_000 + "</article>", None, None)]
    df = spark.createDataFrame(rows, schema).repartition(2)
    found = Counter((r.page_id, r.n_chars) for r in html_extraction.extract(df).collect())
    size = len(f"é&A\n{PARAGRAPH}")
    assert found == {(1, size): 2, (None, size): 1, (2, 0): 1, (3, 0): 1, (4, 20_000 * (len(PARAGRAPH) + 1) - 1): 1}
    assert html_extraction.extract(df.limit(0)).columns == ["page_id", "url", "text", "n_chars"]
    assert html_extraction.extract(df.limit(0)).count() == 0


def test_url_filters(spark):
    cases = {
        "https://a.com/x": ("a.com", "/x", "com/", "allow"),
        "http://example.com/en/1?q": ("example.com", "/en/1", "example.com/en/", "block"),
        "http://m.Example.com/en/": ("m.example.com", "/en/", "example.com/en/", "block"),
        "http://www.example.com/en/": ("www.example.com", "/en/", "www.example.com/en/", "allow"),
        "ftp://b.net/es/#f": ("b.net", "/es/", "net/es/", "block"),
        "http://planet/fr/": ("planet", "/fr/", None, None),
        "http://free-bets.example.org/en/1": ("free-bets.example.org", "/en/1", None, "block"),
        "http://wiki.example.org/en/1": ("wiki.example.org", "/en/1", None, "allow"),
        "nothing": ("", "", None, None),
        None: ("", "", None, None),
    }
    rows = spark.createDataFrame([(u, "x") for u in cases], "url string, host string")
    for r in url_filters.url_filter(rows).collect():
        host, path, rule, verdict = cases[r["url"]]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == verdict or verdict is None and r["verdict"] in ("allow", "block")
    assert url_filters.url_filter(rows.limit(0)).count() == 0


def test_language_id(spark, empty):
    words = {"a": ["thing", "with", "other"], "b": ["für", "nicht", "ßein"], "c": ["мир", "дом", "кот"]}
    rng = np.random.default_rng(5)
    rows = [
        (k, " ".join(rng.choice(words[lang], 30)), lang)
        for k, lang in enumerate([*"abc"] * 20)
    ]
    rows += [(900, None, "a"), (901, "123 ,", None), (902, "", "b"), (903, rows[0][1] + " " + rows[2][1] * 3, None)]
    found = by_id(language_id.language_id(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")))
    assert all(found[k]["lang_pred"] == rows[k][2] for k in range(60))
    assert {found[k]["lang_pred"] for k in (900, 901, 902)} == {"und"}
    assert [s["lang"] for s in found[903]["spans"]] == ["a", "c"] and found[903]["lang_pred"] == "c"
    assert all(r["held_out"] == (zlib.crc32(str(k).encode()) % 4 == 2) for k, r in found.items())
    assert language_id.language_id(empty).count() == 0


def test_language_edges(spark):
    """Numerals are no letters, unknown scripts weigh nothing, rare languages are kept."""
    words = {"aa": "kano mira solu tapi reno ", "bb": "zhux vrot glim pfex skrun ", "cc": "eille oun "}
    schema = "doc_id bigint, text string, lang string"
    rows = [(k, words[lang] * 20, lang) for k, lang in enumerate(["aa"] * 300 + ["bb"] * 300 + ["cc"] * 3)]
    odd = ["½ ² Ⅷ 12", "Кириллица слово", "kano mira ½½½½½½½½ Ⅷ", None, "12 3_4 !"]
    rows += [(1000 + k, t, None) for k, t in enumerate(odd)] + [(None, words["cc"], "cc")]
    df = spark.createDataFrame(rows, schema)
    model = language_id.train(df.where("doc_id is not null"), train_rows=30)
    assert model.languages == ["aa", "bb", "cc"]
    found = {r.doc_id: r for r in language_id.identify(df, model).collect()}
    assert [found[1000 + k].lang_pred for k in (0, 3, 4)] == ["und"] * 3
    assert (found[1001].lang_pred, found[1001].score) == ("aa", 0.0)
    assert (found[1002].lang_pred, found[1002].score) == ("aa", 1.0)
    assert found[None].lang_pred == "cc" and found[601].lang_pred == "cc"
    full = language_id.language_id(df).where("doc_id is null").first()
    assert full.held_out is False


def test_viterbi_is_the_best_of_all_paths():
    rng = np.random.default_rng(4)
    for steps, labels in ((1, 3), (5, 2), (4, 3), (6, 3)):
        emissions = rng.normal(size=(steps, 1, labels)) * 5
        path = language_id.viterbi(emissions, 3.0)[:, 0]

        def total(p):
            own = sum(emissions[t, 0, k] for t, k in enumerate(p))
            return own - 3.0 * sum(a != b for a, b in zip(p, p[1:]))

        best = max(itertools.product(range(labels), repeat=steps), key=total)
        assert total(path) == pytest.approx(total(best))


def test_quality_sample_is_bounded_in_rows_and_bytes(spark, monkeypatch):
    rows = [(k, f"line {k}\n" * 50, k % 2) for k in range(400)] + [(None, "x", 1), (9999, "y" * 5000, 1)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, quality int")
    seen = []
    monkeypatch.setattr(quality_classifier, "fit", lambda texts, labels: seen.append(texts))
    monkeypatch.setattr(quality_classifier, "TRAIN_TEXT", 4000)
    quality_classifier.train(df, train_bytes=40_000)
    assert 20_000 < sum(len(t) for t in seen[0]) <= 40_000 and max(map(len, seen[0])) < 4000
    monkeypatch.setattr(quality_classifier, "TRAIN_ROWS", 30)
    quality_classifier.quality(df.select("doc_id", "text"), df.select("doc_id", "quality"))
    assert 5 < len(seen[1]) < 60


def test_quality_classifier(spark, docs, empty):
    good = "The text of a line, as people write it.\nAnother line follows here."
    bad = "BUY!! NOW!! ### $$$ ***\nBUY!! NOW!! ### $$$ ***"
    rows = [(k, good if k % 2 else bad) for k in range(60)] + [(70, None), (71, "")]
    texts = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = texts.where("doc_id < 60").select("doc_id", (F.col("doc_id") % 2).alias("quality"))
    found = by_id(quality_classifier.quality(texts, labels))
    assert all(found[k]["predicted"] == k % 2 for k in range(60))
    assert all(0 <= r["score"] <= 1 for r in found.values()) and len(found) == 62
    unlabelled = quality_classifier.quality(docs, labels.limit(0)).collect()
    assert {r["score"] for r in unlabelled} == {0.5}
    assert quality_classifier.quality(empty, labels).count() == 0


def test_forward_backward_sums_over_all_paths():
    rng = np.random.default_rng(2)
    emit, moves = rng.normal(size=(4, 1)), rng.normal(size=(2, 2))
    good, _ = quality_classifier.forward_backward(emit, np.ones((4, 1), bool), moves)
    weight = np.zeros(4)
    total = 0.0
    for path in itertools.product((0, 1), repeat=4):
        own = np.exp(sum(emit[k, 0] * y for k, y in enumerate(path)) + sum(moves[a, b] for a, b in itertools.pairwise(path)))
        total += own
        weight += own * np.array(path)
    assert np.allclose(good[:, 0], weight / total)
