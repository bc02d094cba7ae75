"""Patterns against a plain reading of them; random strings among ordinary text."""

import base64
import hashlib
import random
import string

import numpy as np
import pytest
from stratiform.llm import secret_scan as ss

DOCS = "doc_id bigint, text string, spans string, base string"
NAMES = ("password", "passwd", "secret", "token", "api_key", "apikey")
VALUE = set(string.ascii_letters + string.digits + "+/_.=-")


def lower(text):
    return "".join(c.lower() if c in string.ascii_uppercase else c for c in text)


def run(text, at, allowed):
    end = at
    while end < len(text) and text[end] in allowed:
        end += 1
    return end


def assignment(text, at):
    """End of an assignment that starts here and where its value starts, by every way to read it."""
    for name in NAMES:
        if lower(text[at : at + len(name)]) != name:
            continue
        i = at + len(name)
        for quote in (1, 0):
            j = i + 1 if quote and text[i : i + 1] in tuple("\"'") else i
            if quote and j == i:
                continue
            j = run(text, j, " ")
            if text[j : j + 1] not in tuple(":="):
                continue
            j = run(text, j + 1, " ")
            if text[j : j + 1] in tuple("\"'"):
                j += 1
            end = run(text, j, VALUE)
            if end > j:
                return end, j
    return None


def plain(text):
    spans, i = [], 0
    while i < len(text):
        got = assignment(text, i)
        if got:
            if got[0] - got[1] >= 6:
                spans.append((i, 0, got[0]))
            i = got[0]
        else:
            i += 1
    for kind, head, allowed, least in (
        (1, "AKIA", string.ascii_uppercase + string.digits, 20),
        (2, "", "0123456789abcdef", 24),
    ):
        i = 0
        while i < len(text):
            end = run(text, i + len(head), allowed) if text.startswith(head, i) else i
            if end > i + len(head):
                if end - i >= least:
                    spans.append((i, kind, end))
                i = end
            else:
                i += 1
    return sorted(spans)


def test_patterns_equal_a_plain_reading():
    rng = random.Random(5)
    bits = ["password", "SECRET", "Token", "api_key", "APIKEY", "ſecret", "toKen", ":", "=", " ", "'",
            '"', "ab", "abcdef", "A" * 6, "AKIA", "AKIA" + "X9" * 8, "f0" * 12, "f0" * 11, "é", "\n",
            "x.y-z_/+=", "tokentoken", "\t", "12345"]
    for _ in range(6000):
        text = "".join(rng.choices(bits, k=rng.randrange(12)))
        assert ss.base_spans(text) == plain(text), text


@pytest.fixture(scope="module")
def ordinary():
    """Words of many lengths, with names as programs and addresses have them."""
    rng = np.random.default_rng(2)
    syllables = ["the", "tion", "re", "an", "ing", "ou", "st", "ver", "ein", "la", "que", "er", "con"]
    made = []
    for _ in range(400):
        words = ["".join(rng.choice(syllables, rng.integers(1, 7))) for _ in range(150)]
        words[3] = "/".join(words[4:8])
        words[9] = "-".join(words[10:13])
        words[14] = "".join(w.title() for w in words[15:18])
        words[19] = f"{words[20]}_{words[21]}_2024"
        words[30] = words[30].title() + str(rng.integers(1000))
        made.append(" ".join(words) + ".")
    return made


def planted(rng):
    raw = bytes(rng.integers(0, 256, 30, dtype=np.uint8))
    yield base64.b64encode(raw).decode()
    yield base64.urlsafe_b64encode(raw).decode()
    yield base64.b32encode(raw).decode()
    yield "".join(rng.choice(list(string.ascii_letters + string.digits), 40))
    yield "".join(rng.choice(list(string.ascii_uppercase + string.digits), 40))


def test_random_strings_are_found_and_ordinary_ones_are_not(spark, ordinary):
    rng = np.random.default_rng(8)
    texts, wanted = list(ordinary), {}
    for k, secret in enumerate([s for _ in range(8) for s in planted(rng)]):
        at = texts[k].index(" ", 200) + 1
        texts[k] = f"{texts[k][:at]}{secret} {texts[k][at:]}"
        wanted[k] = (at, at + len(secret.rstrip("=")))
    df = spark.createDataFrame([(k, t, "clash", "clash") for k, t in enumerate(texts)], DOCS)
    rows = ss.scan(df.repartition(4)).collect()
    found = {(r.doc_id, s.start, s.end) for r in rows for s in r.spans if s.kind == ss.RANDOM}
    right = {(k, *span) for k, span in wanted.items()}
    assert len(right & found) >= 0.9 * len(right)
    assert len(found - right) <= 0.05 * len(found)
    # Alone, without anything random beside it, ordinary text has nothing to find.
    df = spark.createDataFrame([(k, t, "", "") for k, t in enumerate(ordinary)], DOCS)
    assert all(not r.spans for r in ss.scan(df).collect())


def test_rows_that_are_odd(spark):
    hex_40 = "0123456789abcdef0123456789abcdef01234567"
    long = "the word " * 200_000 + f"token={hex_40}"
    texts = ["", None, " ", f"é𝒳 token = '{hex_40}'", f"é𝒳 token = '{hex_40}'", "passwd: AKIA" + "Q7" * 9, long]
    rows = [(k, t, "x", "y") for k, t in enumerate(texts)] + [(None, "Secret=abc.def", "x", "y")] * 2
    got = ss.report(spark.createDataFrame(rows, DOCS).repartition(3)).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    nothing = hashlib.sha256(b"").hexdigest()
    for k in (0, 1, 2):
        assert by_id[k][1:] == (0, 0, 0, nothing, "")
    spans = "assign:3:52,hex:12:52"
    assert by_id[3][1:] == (1, 0, 1, hashlib.sha256(spans.encode()).hexdigest(), spans)
    assert by_id[4][1:] == by_id[3][1:]
    assert by_id[5].spans == "assign:0:30,access:8:30"
    at = len("the word ") * 200_000
    assert by_id[6].spans == f"assign:{at}:{at + 46},hex:{at + 6}:{at + 46}"
    assert by_id[None].spans == "assign:0:14"
    assert ss.report(spark.createDataFrame([], DOCS)).collect() == []


def test_thresholds_follow_the_rule():
    # 1,000 ordinary candidates below 2, one at 5: its chance 2.9e-7 times 1,001 is under 1 %.
    assert ss.thresholds({(0, 15): 1000, (0, 50): 1})[0] == pytest.approx(5.0)
    # The same score in a band with a million candidates is not enough.
    assert ss.thresholds({(0, 15): 1_000_000, (0, 50): 1})[0] == float("inf")
    # Bands do not help each other.
    assert ss.thresholds({(0, 20): 100, (1, 60): 1000})[0] == float("inf")
