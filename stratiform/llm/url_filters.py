"""URL filters: rules by host and path, and a model for what no rule covers.

The model is a logistic regression over hashed character n-grams of host and path, trained
in SQL from a small labelled table: as the table is small, the regression is fitted over
its kernel matrix by gradient steps in one aggregate, and the weights of the hash buckets
follow from the fitted examples. Scoring is one expression per row: no shuffle, no Python
in tasks, no state that grows with the input.

A null URL, or one without ``://``, has an empty host and path; no rule fits it and the
model judges its bias alone. Repeated rows stay repeated, an empty table gives an empty table.
Where rules of one length fit, the first in order of name wins.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.llm.common import let

BUCKETS = 2048
SIZES = (3, 4, 5)
STEPS, RATE, DECAY = 200, 0.05, 0.001


@dataclass(frozen=True)
class UrlRule:
    verdict: str
    rule: str

    @property
    def host(self) -> str:
        return self.rule.partition("/")[0]

    @property
    def path(self) -> str:
        _, slash, rest = self.rule.partition("/")
        return slash + rest


RULES = (
    UrlRule("allow", "com/"),
    UrlRule("block", "example.com/en/"),
    UrlRule("allow", "www.example.com/en/"),
    UrlRule("block", "net/es/"),
    UrlRule("block", "net/fr/"),
)

# The labelled table: host, path, and 1 for what is to be blocked.
_BLOCKED_HOSTS = (
    "casino-win.example.org", "www.casino-royal.test", "m.casino-win.example.net",
    "free-bets.example.net", "blog.free-bets.example.org", "bets-online.test",
    "cheap-pills.example.com", "www.cheap-pills.example.org", "pills-shop.test",
    "adult-x.example.net", "m.adult-x.example.org", "adult-chat.test",
    "spam-farm.example.org", "www.spam-farm.example.net", "link-farm.test",
    "ads-track.example.com", "m.ads-track.example.net", "track-click.test",
)
_ALLOWED_HOSTS = (
    "news.example.org", "www.daily-post.example.net", "blog.theran.example.org",
    "www.library.test", "m.tionsh.example.net", "docs.manual.test", "wiki.example.org",
    "www.school.example.com", "thther.example.org", "museum.test", "blog.thernd.example.net",
    "www.city-hall.example.net", "weather.example.org", "m.ththou.example.org",
    "recipes.test", "blog.travel.example.com", "science.example.net", "www.ththwh.example.org",
)
_PATHS = ("/", "/en/14.html", "/de/612", "/fr/176/", "/es/750")
LABELLED = tuple(
    (host, path, label)
    for label, hosts in ((1, _BLOCKED_HOSTS), (0, _ALLOWED_HOSTS))
    for k, host in enumerate(hosts)
    for path in (_PATHS[k % 5], _PATHS[(k + 2) % 5])
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    whole = F.coalesce(url, F.lit(""))
    host = F.regexp_extract(whole, r"(?s)^.*?://([^/?#]*)", 1)
    path = F.regexp_extract(whole, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), path


def _grams(text: Column, part: str) -> Column:
    """Hash buckets of the n-grams of a text with marked ends."""

    def of(letters):
        def gram(n):
            def at(i):
                letters_of = F.concat_ws("", *[F.get(letters, i + k) for k in range(n)])
                return F.pmod(F.xxhash64(F.lit(part), letters_of), F.lit(BUCKETS)).cast("int")

            return F.when(
                F.size(letters) >= n, F.transform(F.sequence(F.lit(0), F.size(letters) - n), at)
            ).otherwise(F.array().cast("array<int>"))

        return F.concat(*[gram(n) for n in SIZES])

    empty = F.array().cast("array<int>")
    return F.when(text == "", empty).otherwise(
        let(F.split(F.concat(F.lit("^"), text, F.lit("$")), ""), of)
    )


def _features(host: Column, path: Column) -> Column:
    return F.concat(_grams(host, "host"), _grams(path, "path"))


def train(spark: SparkSession, labelled=LABELLED) -> list[float]:
    """Weight of each bucket, the bias last. Collects at most ``BUCKETS`` rows."""
    values = ", ".join(f"({k}, '{h}', '{p}', {y})" for k, (h, p, y) in enumerate(labelled))
    table = spark.sql(f"select * from values {values} as t(i, host, path, y)")
    one = (
        table.withColumn("grams", _features(F.col("host"), F.col("path")))
        .withColumn("n", F.size("grams"))
        .select("i", "y", "n", F.explode("grams").alias("bucket"))
        .groupBy("i", "y", "n", "bucket")
        .agg((F.count("*") / F.sqrt("n")).alias("x"))
        .select("i", "y", "bucket", "x")
    )
    every = table.select("i", "y", F.lit(BUCKETS).alias("bucket"), F.lit(1.0).alias("x"))
    entries = one.unionByName(every)
    other = entries.select(F.col("i").alias("j"), "bucket", F.col("x").alias("z"))
    cells = entries.join(other, "bucket").groupBy("i", "y", "j").agg(F.sum(F.col("x") * F.col("z")).alias("k"))
    rows = cells.groupBy("i", "y").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("j", "k"))), lambda c: c["k"]).alias("k")
    )
    table_of = rows.agg(F.sort_array(F.collect_list(F.struct("i", "y", "k"))).alias("rows"))

    def total(values):
        return F.aggregate(values, F.lit(0.0), lambda s, v: s + v)

    def step(a, _):
        def moved(r, i):
            margin = total(F.zip_with(r["k"], a, lambda k, v: k * v))
            error = r["y"] - 1 / (1 + F.exp(-margin))
            return F.get(a, i) + RATE * (error - DECAY * F.get(a, i))

        return F.transform(F.col("rows"), moved)

    steps = F.sequence(F.lit(1), F.lit(STEPS))
    start = F.transform(F.col("rows"), lambda r: F.lit(0.0))
    fitted = table_of.select(
        F.explode(
            F.arrays_zip(
                F.transform("rows", lambda r: r["i"]).alias("i"),
                F.aggregate(steps, start, step).alias("a"),
            )
        ).alias("f")
    ).select("f.i", "f.a")
    weights = entries.join(fitted, "i").groupBy("bucket").agg(F.sum(F.col("x") * F.col("a")).alias("w"))
    out = [0.0] * (BUCKETS + 1)
    for row in weights.collect():
        out[row["bucket"]] = row["w"]
    return out


def url_filter(pages: DataFrame, rules=RULES, weights: list[float] | None = None) -> DataFrame:
    """The rows with host, path, fitting rule, probability of being blocked, and verdict."""
    weights = weights or train(pages.sparkSession)
    host, path = host_and_path(F.col("url"))
    parts = pages.withColumns({"host": host, "path": path})
    rule, ruled = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (-len(r.rule), r.rule), reverse=True):
        own = (F.col("host") == r.host) | F.endswith(F.col("host"), F.lit("." + r.host))
        fits = own & F.startswith(F.col("path"), F.lit(r.path))
        rule = F.when(fits, F.lit(r.rule)).otherwise(rule)
        ruled = F.when(fits, F.lit(r.verdict)).otherwise(ruled)
    table = F.expr("array(" + ", ".join(f"{w:.6e}D" for w in weights[:-1]) + ")")

    def margin(grams):
        found = F.aggregate(grams, F.lit(0.0), lambda s, b: s + F.get(table, b))
        return F.lit(weights[-1]) + found / F.sqrt(F.greatest(F.size(grams), F.lit(1)))

    scored = parts.withColumns(
        {
            "rule": rule,
            "ruled": ruled,
            "score": 1 / (1 + F.exp(-let(_features(F.col("host"), F.col("path")), margin))),
        }
    )
    own = F.when(F.col("score") >= 0.5, F.lit("block")).otherwise(F.lit("allow"))
    return scored.withColumn("verdict", F.coalesce("ruled", own)).drop("ruled")
