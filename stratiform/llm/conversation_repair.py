"""Structure of conversations, repaired by iterative-deepening A*.

The rows of a conversation, by turn, have to become an optional system row and then user and
assistant rows in alternation, the last by the assistant; nothing at all is fine, too. Edits:
keep a row (0), give it the role user or assistant (2), delete it (3), insert an empty user or
assistant row anywhere (2). Blank rows and repetitions have to be deleted; a truncated row that
stays costs 1 more. The answer is the cheapest list of edits, the ASCII-least of equals.

The search goes depth-first through the edits in ASCII order (D, I, K, R) under a bound on the
cost. A state is the next row and what may follow there (``START`` and so on); the table of
failed states holds for each the least cost it is known to need, over all bounds. A bound that
fails is raised to the least cost that exceeded it, so the first path found is the answer.

One search covers at most ``ROWS`` rows. A longer conversation is sorted by ranges, cut into
chunks of ``CHUNK`` rows, and each chunk is searched from every state to every state, all in
parallel. One pass backwards over the chunks adds these costs up to what remains after each
chunk; a second search of each chunk, again from every state, takes the answer under what
remains; a pass forwards picks the state that each chunk begins in. Only chunk records,
``CHUNK`` times fewer than rows, meet in one task there. The rows themselves pass one by one, in order, through the task that
hashes them in the end, as one digest over a whole conversation has to.

Defined results: a null conversation id is a conversation of its own. Null turns come first
and do not count for gaps. A null role or text is one space, so such a role is neither kept nor
legal and such a text is blank. Rows of equal turn are taken by role and text in byte order;
rows that are equal in all are repetitions after the first. Other columns are ignored,
whatever their names. An empty table gives an empty result, very long texts are hashed as they are.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from stratiform.llm.common import staged

# What may come next: anything, the first user, an assistant, a user or the end.
START, FIRST_USER, ASSISTANT, USER = range(4)
# Where a kept row of an initial leads, and what a row that takes any role becomes.
KEEPS = ({"s": FIRST_USER, "u": ASSISTANT}, {"u": ASSISTANT}, {"a": USER}, {"u": ASSISTANT})
GIVES = (("user", ASSISTANT), ("user", ASSISTANT), ("assistant", USER), ("user", ASSISTANT))
# Rows that still have to be inserted at the end of a conversation, and their cost.
TAILS = ("", "II", "I", "")
END = (0, 4, 2, 0)
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
NEVER = 1 << 60
LEGAL = {"su", "ua", "au"}
WHITE = " \t\n\x0b\x0c\r"

ROWS, CHUNK = 128, 32
CHARS = 1 << 24

EDITS = (
    "conv_id {id}, step bigint, edit string, turn {turn}, fault string, "
    "was_role string, role string, text string"
)
REPORT = (
    "conv_id {id}, gaps bigint, blank bigint, duplicate bigint, truncated bigint, "
    "illegal bigint, cost bigint, audit string, repaired_sha256 string"
)


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows after damage, chosen by a hash of conversation and turn.

    A dropped row stays as one that is not ``present``, so its conversation is not forgotten.
    """
    space = F.lit(" ")
    key = F.concat_ws(
        ":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")]
    )
    rows = conversations.select(
        "conv_id",
        "turn",
        F.coalesce("role", space).alias("role"),
        F.coalesce("text", space).alias("text"),
        (F.crc32(key) % 20).alias("_kind"),
    )
    kind = F.col("_kind")
    text = (
        F.when(kind.isin(0, 1), "")
        .when(kind == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text"))
    )
    return rows.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        (kind != 0).alias("present"),
        F.explode(F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))),
    ).drop("col")


# --- the search --------------------------------------------------------------


def _symbol(role: str, text: str, duplicate: bool) -> str:
    """A row as the search sees it: d to be deleted, else its initial, a capital if truncated."""
    body = text.rstrip(WHITE)
    if not body or duplicate:
        return "d"
    initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
    return initial if body[-1] in ".!?" else initial.upper()


def search(
    symbols: str,
    entry: int = START,
    remains: tuple[int, ...] = END,
    needs: dict[tuple[int, int], int] | None = None,
) -> tuple[int, str, int]:
    """Cost of the rows and of what remains after them, the edits, the state after them.

    ``remains`` is the cost after the last row by state, ``NEVER`` where it may not end.
    ``needs`` is the table of failed states; searches that only differ in ``entry`` share it.
    """
    n, least_rest = len(symbols), min(remains)
    floor = [least_rest] * (n + 1)
    for i in range(n - 1, -1, -1):
        own = DELETE if symbols[i] == "d" else TRUNCATED if symbols[i].isupper() else 0
        floor[i] = floor[i + 1] + own
    needs = {} if needs is None else needs

    def moves(i, q):
        row = symbols[i]
        yield "D", DELETE, i + 1, q
        given = GIVES[q][1]
        yield "I", INSERT, i, given
        if row != "d":
            more = TRUNCATED if row.isupper() else 0
            kept = KEEPS[q].get(row.lower())
            if kept is not None:
                yield "K", more, i + 1, kept
            if kept != given:
                yield "R", REROLE + more, i + 1, given

    def dive(i, q, budget):
        if i == n:
            if remains[q] <= budget:
                return "", q
            needs[i, q] = remains[q]
            return None
        least = NEVER
        for edit, cost, j, after in moves(i, q):
            if cost + needs.get((j, after), floor[j]) <= budget:
                found = dive(j, after, budget - cost)
                if found is not None:
                    return edit + found[0], found[1]
            least = min(least, cost + needs.get((j, after), floor[j]))
        needs[i, q] = max(least, needs.get((i, q), 0))
        return None

    bound = needs.get((0, entry), floor[0])
    while True:
        found = dive(0, entry, bound)
        if found is not None:
            return bound, *found
        bound = needs[0, entry]


def crossing(symbols: str) -> list[int]:
    """Cost of the rows from each state to each state, row by row, ``NEVER`` if impossible."""
    costs = [[NEVER] * 4 for _ in range(4)]
    # Before any user row, rows can only have been deleted, but for one system row.
    nothing = DELETE * len(symbols)
    costs[START][START] = costs[FIRST_USER][FIRST_USER] = nothing
    system = [TRUNCATED if row == "S" else 0 for row in symbols if row in "sS"]
    if system:
        costs[START][FIRST_USER] = nothing - DELETE + min(system)
    for leave in (ASSISTANT, USER):
        only, needs = tuple(0 if q == leave else NEVER for q in range(4)), {}
        for entry in range(4):
            costs[entry][leave] = search(symbols, entry, only, needs)[0]
    return [cost for row in costs for cost in row]


@functools.lru_cache(maxsize=1 << 14)
def _whole(symbols: str) -> str:
    _, edits, after = search(symbols)
    return edits + TAILS[after]


# --- rows in, edits out ------------------------------------------------------


def _rows(batches) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[column.to_pylist() for column in batch.columns])


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows in batches of bounded rows and characters."""

    def batch(block):
        columns = [pa.array(c, f.type) for c, f in zip(zip(*block), schema)]
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    block, chars = [], 0
    for row in rows:
        block.append(row)
        chars += sum(len(v) for v in row if isinstance(v, str))
        if len(block) == 1024 or chars >= 1 << 23:
            yield batch(block)
            block, chars = [], 0
    if block:
        yield batch(block)


def _applied(conv_id, rows: Iterator[tuple]) -> Iterator[tuple]:
    """Edits of one conversation. Its rows come with the edits up to and with their own; what
    follows the last row comes with it."""
    state, step = START, 0
    for turn, role, text, fault, edits in rows:
        for edit in edits:
            given, after = GIVES[state]
            if edit == "D":
                yield conv_id, step, edit, turn, fault, role, None, text
            elif edit == "K":
                yield conv_id, step, edit, turn, fault, role, role, text
                state = KEEPS[state][role[:1]]
            elif edit == "R":
                yield conv_id, step, edit, turn, fault, role, given, text
                state = after
            else:
                yield conv_id, step, edit, None, None, None, given, ""
                state = after
            step += 1
    if not step:
        yield conv_id, None, None, None, None, None, None, None


def _fault(symbol: str, text: str) -> str | None:
    if symbol == "d":
        return "duplicate" if text.strip(WHITE) else "blank"
    return "truncated" if symbol.isupper() else None


def _split(edits: str) -> list[str]:
    """Edits by row; the ones after the last row go with it."""
    parts = re.findall("I*[DKR]", edits)
    if parts:
        parts[-1] += edits[len("".join(parts)) :]
    return parts


def _short_edits(batches) -> Iterator[tuple]:
    """Rows (conv_id, turn, role, text, present), each conversation in order, to edits."""
    for conv_id, group in itertools.groupby(_rows(batches), key=lambda r: r[0]):
        rows, seen, symbols = [], set(), []
        for _, turn, role, text, present in group:
            if present:
                symbols.append(_symbol(role, text, (role, text) in seen))
                seen.add((role, text))
                rows.append((turn, role, text))
        parts = _split(_whole("".join(symbols)))
        yield from _applied(
            conv_id,
            (
                (*row, _fault(symbol, row[2]), part)
                for row, symbol, part in zip(rows, symbols, parts)
            ),
        )


def _reports(edits: Iterator[tuple]) -> Iterator[tuple]:
    """Edits, each conversation in order, to one row per conversation."""
    for conv_id, group in itertools.groupby(edits, key=lambda e: e[0]):
        turns, least, last = 0, None, None
        faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        illegal, cost, before, audit = 0, 0, None, []
        digest, started = hashlib.sha256(), False
        for _, _, edit, turn, fault, was_role, role, text in group:
            if edit is None:
                continue
            audit.append(edit)
            if edit != "I":
                if turn is not None and turn != last:
                    turns, least, last = turns + 1, turn if least is None else least, turn
                if fault:
                    faults[fault] += 1
                initial = was_role[:1]
                illegal += before is not None and before + initial not in LEGAL
                before = initial
            cost += {"D": DELETE, "I": INSERT, "K": 0, "R": REROLE}[edit]
            cost += TRUNCATED if fault == "truncated" and edit != "D" else 0
            if edit != "D":
                digest.update(f"{chr(10) if started else ''}{role}:{text}".encode())
                started = True
        gaps = last - least + 1 - turns if turns else 0
        yield conv_id, gaps, *faults.values(), illegal, cost, "".join(audit), digest.hexdigest()


# --- conversations longer than one search ------------------------------------


def _numbered(batches) -> Iterator[tuple]:
    """Rows in order get their place: task and number; and what the search needs of them."""
    part = TaskContext.get().partitionId()
    for place, (conv_id, turn, role, text) in enumerate(_rows(batches)):
        digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
        symbol = _symbol(role, text, False)
        yield conv_id, part, place, turn, role, text, symbol, digest


def _backwards(batches) -> Iterator[tuple]:
    """Chunks, last first, get the cost of what follows them, by state."""
    for _, group in itertools.groupby(_rows(batches), key=lambda r: r[0]):
        remains, last = END, True
        for conv_id, part, chunk, symbols, costs in group:
            yield conv_id, part, chunk, symbols, list(remains), last
            remains = [
                min(min(costs[4 * q + r] + remains[r] for r in range(4)), NEVER) for q in range(4)
            ]
            last = False


def _answers(batches) -> Iterator[tuple]:
    """The answer of each chunk by the state it begins in, and the state it leaves."""
    for conv_id, part, chunk, symbols, remains, last in _rows(batches):
        edits, leaves, needs = [], [], {}
        for entry in range(4):
            _, found, after = search(symbols, entry, tuple(remains), needs)
            edits.append(found + (TAILS[after] if last else ""))
            leaves.append(after)
        yield conv_id, part, chunk, edits, leaves


def _forwards(batches) -> Iterator[tuple]:
    """The answer of each chunk for the state that it begins in."""
    for _, group in itertools.groupby(_rows(batches), key=lambda r: r[0]):
        state = START
        for conv_id, part, chunk, edits, leaves in group:
            yield conv_id, part, chunk, edits[state]
            state = leaves[state]


def _long_edits(batches) -> Iterator[tuple]:
    """Chunk records, each before its rows, to edits."""

    def with_edits(group):
        parts = iter(())
        for _, _, _, chunk_edits, turn, role, text, fault in group:
            if chunk_edits is not None:
                parts = iter(_split(chunk_edits))
            else:
                yield turn, role, text, fault, next(parts)

    for conv_id, group in itertools.groupby(_rows(batches), key=lambda r: r[0]):
        yield from _applied(conv_id, with_edits(group))


def _map(df: DataFrame, step, schema: str) -> DataFrame:
    """``step`` from rows to rows, over the rows of each task in their order."""
    fields = to_arrow_schema(T.StructType.fromDDL(schema))
    return df.mapInArrow(lambda batches: _batches(step(batches), fields), schema)


def _in_order(df: DataFrame, *columns) -> DataFrame:
    return df.repartition("conv_id").sortWithinPartitions("conv_id", *columns)


def _long(rows: DataFrame, chunk: int, kinds: dict[str, str]) -> DataFrame:
    """Rows of long conversations and, before the rows of each chunk, its record."""
    id_type = kinds["id"]
    order = ["conv_id", "turn", "role", "text"]
    by_range = rows.where("present").repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = staged(
        _map(
            by_range.select(*order),
            _numbered,
            f"conv_id {id_type}, part bigint, place bigint, turn {kinds['turn']}, role string, "
            "text string, symbol string, digest binary",
        ),
        "conversations-numbered",
    )
    place = F.struct("part", "place")
    first = (
        numbered.groupBy("conv_id", "digest")
        .agg(F.min(place).alias("f"))
        .select(F.col("f.part").alias("part"), F.col("f.place").alias("place"), F.lit(True).alias("first"))
    )
    known = (
        numbered.select("conv_id", "part", "place", "symbol", F.length("text").alias("_n"))
        .join(first, ["part", "place"], "left")
        .withColumn("symbol", F.when(F.col("first"), F.col("symbol")).otherwise(F.lit("d")))
    )
    number = F.floor(F.col("place") / chunk)
    chunks = (
        known.groupBy("conv_id", "part", number.alias("chunk"))
        .agg(F.array_sort(F.collect_list(F.struct("place", "symbol"))).alias("all"))
        .select("conv_id", "part", "chunk", F.array_join("all.symbol", "").alias("symbols"))
    )
    base = f"conv_id {id_type}, part bigint, chunk bigint, "

    def crossings(batches):
        for *key, symbols in _rows(batches):
            yield *key, symbols, crossing(symbols)

    # The records are small and the searches are not, so the tasks are many, whatever the bytes.
    many = int(numbered.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = chunks.repartition(many, "conv_id", "part", "chunk")
    costs = _map(spread, crossings, base + "symbols string, costs array<bigint>")
    back = _map(
        _in_order(costs, F.desc("part"), F.desc("chunk")),
        _backwards,
        base + "symbols string, remains array<bigint>, last boolean",
    )
    answers = _map(
        back.repartition(many, "conv_id", "part", "chunk"),
        _answers,
        base + "edits array<string>, leaves array<bigint>",
    )
    chosen = _map(_in_order(answers, "part", "chunk"), _forwards, base + "edits string")
    fault = (
        F.when(F.col("symbol") == "d", "blank")
        .when(F.lower("symbol") != F.col("symbol"), "truncated")
    )
    own = numbered.join(first, ["part", "place"], "left").select(
        "conv_id",
        "part",
        "place",
        F.lit(None).cast("string").alias("edits"),
        "turn",
        "role",
        "text",
        F.when((F.col("symbol") != "d") & F.col("first").isNull(), "duplicate")
        .otherwise(fault)
        .alias("fault"),
    )
    records = chosen.select(
        "conv_id",
        "part",
        (F.col("chunk") * chunk).alias("place"),
        "edits",
        *[F.lit(None).cast(own.schema[c].dataType).alias(c) for c in ("turn", "role", "text", "fault")],
    )
    return _in_order(own.unionByName(records), "part", "place", F.col("edits").asc_nulls_last())


def _pieces(rows: DataFrame, longest: int, chars: int):
    """Short conversations in order, and long ones with their answers, or None without any."""
    rows = rows.select(
        "conv_id",
        "turn",
        *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")],
        F.col("present") if "present" in rows.columns else F.lit(True).alias("present"),
    )
    kinds = {"id": rows.schema["conv_id"].dataType.simpleString()}
    kinds["turn"] = rows.schema["turn"].dataType.simpleString()
    sizes = rows.where("present").groupBy("conv_id").agg(
        F.count("*").alias("n"), F.sum(F.length("text").cast("bigint")).alias("chars")
    )
    over = sizes.where((F.col("n") > longest) | (F.col("chars") > chars))
    over = staged(over.select(F.col("conv_id").alias("_id")), "conversations-long")
    if over.isEmpty():
        return _in_order(rows, "turn", "role", "text"), None, kinds
    same = rows["conv_id"].eqNullSafe(over["_id"])
    short = _in_order(rows.join(over, same, "left_anti"), "turn", "role", "text")
    return short, _long(rows.join(over, same, "left_semi"), min(longest, CHUNK), kinds), kinds


def _both(rows: DataFrame, longest: int, chars: int, schema: str, of_edits) -> DataFrame:
    short, long, kinds = _pieces(rows, longest, chars)
    schema = schema.format(**kinds)
    found = _map(short, lambda batches: of_edits(_short_edits(batches)), schema)
    if long is None:
        return found
    return found.unionAll(_map(long, lambda batches: of_edits(_long_edits(batches)), schema))


def repair(rows: DataFrame, longest: int = ROWS, chars: int = CHARS) -> DataFrame:
    """The edits of each conversation in order of ``step``: what each does, to which row, and
    the role and text that it leaves. A conversation without rows has one row without edit.

    ``rows`` has ``conv_id``, ``turn``, ``role``, ``text`` and, if some only stand for their
    conversation, ``present``. Conversations of more rows or characters than ``longest`` and
    ``chars`` are searched chunk by chunk, with the same result.
    """
    return _both(rows, longest, chars, EDITS, lambda edits: edits)


def report(rows: DataFrame, longest: int = ROWS, chars: int = CHARS) -> DataFrame:
    """One row per conversation: faults, cost, edits and a digest of the repaired rows."""
    return _both(rows, longest, chars, REPORT, _reports)
