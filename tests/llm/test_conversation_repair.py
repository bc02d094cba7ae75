"""Repairs against all edits tried, in one search and chunk by chunk."""

import hashlib
import heapq
import random
import zlib
from collections import defaultdict

import pytest
from stratiform.llm import conversation_repair as cr

ROWS = "conv_id bigint, turn bigint, role string, text string, edit string"


def plain(symbols):
    """Cheapest edits, ASCII-least, by uniform cost over whole lists of edits."""
    heap, done = [(0, "", 0, cr.START)], set()
    while heap:
        cost, edits, i, q = heapq.heappop(heap)
        if i == len(symbols) and q in (cr.START, cr.USER):
            return cost, edits
        if (i, q) in done:
            continue
        done.add((i, q))
        given = cr.GIVES[q][1]
        heapq.heappush(heap, (cost + 2, edits + "I", i, given))
        if i < len(symbols):
            row = symbols[i]
            heapq.heappush(heap, (cost + 3, edits + "D", i + 1, q))
            if row != "d":
                more = row.isupper()
                heapq.heappush(heap, (cost + 2 + more, edits + "R", i + 1, given))
                if row.lower() in cr.KEEPS[q]:
                    kept = cr.KEEPS[q][row.lower()]
                    heapq.heappush(heap, (cost + more, edits + "K", i + 1, kept))
    return None


def test_search_finds_the_least_of_the_cheapest():
    rng = random.Random(3)
    for _ in range(3000):
        symbols = "".join(rng.choices("suaxSUAXd", k=rng.randrange(9)))
        cost, edits, after = cr.search(symbols)
        assert (cost, edits + cr.TAILS[after]) == plain(symbols), symbols


def test_crossings_are_exact_and_finite_where_possible():
    rng = random.Random(4)
    for _ in range(200):
        symbols = "".join(rng.choices("suaxUd", k=rng.randrange(1, 6)))
        costs = cr.crossing(symbols)
        for entry in range(4):
            best = min(costs[4 * entry + q] + cr.END[q] for q in range(4))
            assert best == cr.search(symbols, entry)[0]
        assert costs[4 * cr.USER + cr.START] == cr.NEVER


def expected(rows):
    """The report of (conv_id, turn, role, text) before damage, row by row."""
    kept = defaultdict(list)
    for conv_id, turn, role, text in rows:
        key = ":".join(" " if v is None else str(v) for v in (conv_id, turn))
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else text.translate({ord(c): None for c in ".!?"}) if kind == 2 else text
        role = "user" if kind == 4 else role
        kept[conv_id] += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    result = {}
    for conv_id, found in kept.items():
        found.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, symbols, faults = set(), "", defaultdict(int)
        for _, role, text in found:
            body = text.strip(" \t\n\x0b\x0c\r")
            fault = (
                "blank" if not body
                else "duplicate" if (role, text) in seen
                else "truncated" if body[-1] not in ".!?" else None
            )
            seen.add((role, text))
            faults[fault] += 1
            initial = role[:1] if role[:1] in tuple("sua") else "x"
            symbols += "d" if fault in ("blank", "duplicate") else initial.upper() if fault else initial
        cost, audit = plain(symbols)
        out, state, left = [], cr.START, iter(found)
        for edit in audit:
            row = None if edit == "I" else next(left)
            given, after = cr.GIVES[state]
            if edit == "K":
                out.append(f"{row[1]}:{row[2]}")
                state = cr.KEEPS[state][row[1][:1]]
            elif edit != "D":
                out.append(f"{given}:{row[2] if row else ''}")
                state = after
        turns = [t for t, _, _ in found if t is not None]
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(found, found[1:])]
        result[conv_id] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            faults["blank"], faults["duplicate"], faults["truncated"],
            sum(p not in cr.LEGAL for p in pairs), cost, audit,
            hashlib.sha256("\n".join(out).encode()).hexdigest(),
        )
    return result


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    texts = ["Yes.", "no", "", " \t", None, "Why?", "é!", "so\x0b", "x" * 3000 + "."]
    roles = ["user", "assistant", "system", None, "", "tool", "User"]
    made = []
    for conv_id in [*range(60), None]:
        for place in range(rng.randrange(12)):
            turn = rng.choice([place, place, place, None, place * 2, 0, -3])
            made.append((conv_id, turn, rng.choice(roles[:3] * 3 + roles), rng.choice(texts)))
    for place in range(300):
        made.append((1000, place // 2, rng.choice(roles), f"{rng.choice(texts)}{rng.randrange(40)}"))
        made.append((1001, place, ("user", "assistant")[place % 2], f"{place}."))
    return made + made[:20]


def found(spark, rows, **limits):
    df = spark.createDataFrame([(*r, "clash") for r in rows], ROWS).repartition(3)
    got = cr.report(cr.damaged(df), **limits).collect()
    assert len(got) == len({r["conv_id"] for r in got})
    return {r["conv_id"]: tuple(r)[1:] for r in got}


@pytest.mark.parametrize("limits", [{"longest": 100_000}, {}, {"longest": 3}, {"longest": 1}, {"chars": 50}])
def test_report_equals_all_edits_tried(spark, rows, limits):
    assert found(spark, rows, **limits) == expected(rows)


def test_no_rows_after_damage_and_no_rows_at_all(spark):
    dropped = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert found(spark, [(dropped, 0, "user", "a.")]) == {dropped: nothing}
    assert found(spark, []) == {}


def test_edits_say_what_happens_to_each_row(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "cut"), (1, 1, "user", "cut"), (2, 0, "system", "s.")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], ROWS)
    for longest in (100, 1):
        edits = cr.repair(df, longest=longest).orderBy("conv_id", "step").collect()
        assert [(r.conv_id, r.edit, r.fault, r.was_role, r.role, r.text) for r in edits] == [
            (1, "K", None, "user", "user", "Hi."),
            (1, "R", "truncated", "user", "assistant", "cut"),
            (1, "D", "duplicate", "user", None, "cut"),
            (2, "D", None, "system", None, "s."),
        ]
