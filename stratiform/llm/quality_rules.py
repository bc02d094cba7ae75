"""Quality rules as a ledger: every rule is evaluated once per document.

``ledger`` adds the measurements of each text and one number whose bit *k* says that rule
*k* failed. A policy is a named set of rules; ``judged`` applies it with one bitwise AND,
and ``ablation`` counts, from the same bits, what each rule of a policy rejects alone. A
policy can change without any text being read again.

Everything is a column expression: no shuffle, no Python in tasks, a very long text or a
hot source costs no more than its words.

Null texts count as empty: no words, no lines, they fail ``few_words``. Rows are kept as
they come: repeated rows stay repeated, other columns stay as they are, a clashing name
(``n_words`` and so on) is replaced. An empty table gives an empty table.
"""

from __future__ import annotations

import operator
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratiform.llm.common import let, words

SYMBOLS = "#*$%&|<>"


_OPERATORS = {"<": operator.lt, ">": operator.gt, ">=": operator.ge, "=": operator.eq}


@dataclass(frozen=True)
class Rule:
    """A document fails where all comparisons hold: factor, measurement, operator, factor,
    and the measurement or 1 that the second factor goes with."""

    name: str
    comparisons: tuple[tuple[int, str, str, int, str], ...]

    @property
    def sql(self) -> str:
        return " and ".join(f"{a} * {x} {op} {b} * {y}" for a, x, op, b, y in self.comparisons)

    def fails(self, measured: dict[str, Column]) -> Column:
        one = {**measured, "1": F.lit(1)}
        return reduce(
            operator.and_,
            [_OPERATORS[op](one[x] * a, one[y] * b) for a, x, op, b, y in self.comparisons],
        )


# The place in this list is the bit, so new rules go to the end.
RULES = (
    Rule("few_words", ((1, "n_words", "<", 50, "1"),)),
    Rule("repeated_words", ((100, "n_repeat_words", ">", 50, "n_words"),)),
    Rule("symbols", ((100, "n_symbols", ">", 10, "word_chars"),)),
    Rule("repeated_lines", ((100, "n_dup_lines", ">", 30, "n_lines"),)),
    Rule("short_words", ((1, "word_chars", "<", 2, "n_words"),)),
    Rule("long_words", ((1, "word_chars", ">", 25, "n_words"),)),
    Rule("shouting", ((10, "n_marks", ">", 5, "n_words"),)),
    Rule("no_sentence", ((1, "n_words", ">=", 100, "1"), (1, "n_stops", "=", 0, "1"))),
)
BIT = {rule.name: 1 << k for k, rule in enumerate(RULES)}
BASE = ("few_words", "repeated_words")

# Versioned policies: the rules that reject a document.
POLICIES = {
    "v1": BASE,
    "v2": tuple(rule.name for rule in RULES),
}


def mask(policy: str) -> int:
    return sum(BIT[name] for name in POLICIES[policy])


def _count(text: Column, characters: str) -> Column:
    """How many characters of the text are among these."""
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("bigint")


def _repeat_words(w: Column) -> Column:
    """Words in three-word windows that occur twice or more.

    Windows are compared as whole strings. Only a text with a repeated window sorts them:
    equal ones then stand together, and the places of these, in order, each cover three
    words less the overlap with the next.
    """

    def window(i):
        return F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))

    def same(a, b):
        return F.coalesce(a["w"] == b["w"], F.lit(False))

    def covered(places):
        gaps = F.transform(
            places, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(places, k + 1) - p, F.lit(3)))
        )
        return F.aggregate(gaps, F.lit(0).cast("bigint"), lambda s, x: s + x)

    def places(ranked):
        repeated = F.filter(
            ranked, lambda x, k: same(x, F.get(ranked, k - 1)) | same(x, F.get(ranked, k + 1))
        )
        return F.sort_array(F.transform(repeated, lambda x: x["i"]))

    def of(windows):
        ranked = F.sort_array(
            F.transform(windows, lambda x, i: F.struct(x.alias("w"), i.alias("i")))
        )
        return F.when(
            F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("bigint")
        ).otherwise(let(let(ranked, places), covered))

    starts = F.sequence(F.lit(0), F.size(w) - 3)
    return F.when(F.size(w) < 3, F.lit(0).cast("bigint")).otherwise(
        let(F.transform(starts, window), of)
    )


MEASUREMENTS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_marks",
    "n_stops",
    "n_lines",
    "n_dup_lines",
    "n_repeat_words",
)


def _measured(text: Column) -> Column:
    """A struct of the measurements of a text and its failures.

    All of it is one expression whose parts are named by ``let``. Split over columns, a
    filter on the outcome would be pushed below them and copy the words into every use.
    """
    white = " \t\n\x0b\f\r"

    def of(parts):
        whole, w, lines = parts["t"], parts["w"], parts["lines"]
        return F.struct(
            F.size(w).cast("bigint").alias("n_words"),
            F.length(F.translate(whole, white, "")).cast("bigint").alias("word_chars"),
            _count(whole, SYMBOLS).alias("n_symbols"),
            _count(whole, "!").alias("n_marks"),
            _count(whole, ".。?…।۔").alias("n_stops"),
            F.size(lines).cast("bigint").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint").alias("n_dup_lines"),
            _repeat_words(w).alias("n_repeat_words"),
        )

    def with_failures(m):
        each = {name: m[name] for name in MEASUREMENTS}
        bits = [F.when(r.fails(each), F.lit(BIT[r.name])).otherwise(F.lit(0)) for r in RULES]
        failures = reduce(lambda a, b: a.bitwiseOR(b), bits).cast("bigint")
        return F.struct(*[m[name].alias(name) for name in MEASUREMENTS], failures.alias("failures"))

    whole = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda x: F.translate(x, white, "") != "")
    parts = F.struct(whole.alias("t"), words(text).alias("w"), lines.alias("lines"))
    return let(let(parts, of), with_failures)


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with their measurements and ``failures``, one bit per failed rule."""
    rows = docs.withColumn("_ledger", _measured(F.col(text)))
    names = [*MEASUREMENTS, "failures"]
    return rows.withColumns({n: F.col("_ledger")[n] for n in names}).drop("_ledger")


def judged(rows: DataFrame, policy: str = "v2") -> DataFrame:
    """The ledger with ``base_failed`` and ``kept`` as the policy decides."""
    base = sum(BIT[name] for name in BASE)
    failures = F.col("failures")
    return rows.withColumns(
        {
            "base_failed": failures.bitwiseAND(F.lit(base)) != 0,
            "kept": failures.bitwiseAND(F.lit(base | mask(policy))) == 0,
        }
    )


def ablation(rows: DataFrame, policy: str = "v2") -> DataFrame:
    """Per rule of the policy: documents that fail it, and those that fail nothing else.

    The ledger is first summed by its failure bits, at most one row per set of rules, so
    the rest is bitwise work on a table that does not grow.
    """
    by_bits = rows.groupBy(F.col("failures").bitwiseAND(F.lit(mask(policy))).alias("bits")).agg(
        F.count("*").alias("n")
    )
    rules = F.explode(
        F.array(
            *[
                F.struct(F.lit(n).alias("rule"), F.lit(BIT[n]).alias("bit"))
                for n in POLICIES[policy]
            ]
        )
    )
    each = by_bits.select("bits", "n", rules.alias("r")).select("bits", "n", "r.rule", "r.bit")
    hit = F.col("bits").bitwiseAND(F.col("bit")) != 0
    return each.groupBy("rule").agg(
        F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0)).alias("n_failed"),
        F.coalesce(F.sum(F.when(F.col("bits") == F.col("bit"), F.col("n"))), F.lit(0)).alias(
            "n_only"
        ),
    )
