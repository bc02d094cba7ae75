"""From raw documents to packed training windows.

Each stage takes all rows that the one before kept; all but the last return the columns of
``documents``. Between stages the rows lie as Parquet in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.llm import exact_dedup, jaccard_join, packing, quality_rules, suffix_dedup
from stratiform.llm.common import WHITE_SPACE, read, staged


# Bytes from which a repeated passage goes: of shared windows of 50 words the shortest seen has 239.
PASSAGE = 200


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule of the current policy rejects."""
    rows = quality_rules.judged(quality_rules.ledger(docs))
    return rows.where("kept").select(docs.columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts.

    A row is known by its id and a digest of its text as the operator compares it, so
    different texts under one id all stay, and so do texts without an id. Of equal rows one stays.
    """
    plain = F.regexp_replace(F.coalesce("text", F.lit("")), WHITE_SPACE, " ")
    named = docs.withColumn("_key", _row_key(F.sha2(plain, 256)))
    # Of texts that only rows without an id have, one of these rows stays.
    kept = exact_dedup.exact_dedup(docs).where(F.col("doc_id").eqNullSafe(F.col("keep_id")))
    kept = kept.select(_row_key(F.col("text_sha256")).alias("_key"))
    return named.join(kept, "_key", "left_semi").dropDuplicates(["_key"]).drop("_key")


def _row_key(digest: Column) -> Column:
    """Id and digest as one value that is never null, so join and copies share a shuffle."""
    return F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), digest)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8.

    Links are between ids, so a document without an id has none and stays; of several
    documents with one id all stay, or none.
    """
    found = jaccard_join.jaccard_join(docs.where("doc_id is not null"), percent=80, width=5)
    gone = found.where(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti")


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that start elsewhere, too.

    Passages are bytes, ``PASSAGE`` of them, which 50 words of any language exceed; a character
    of which a part is left goes. A document that keeps nothing stays as an empty text.
    """
    rest = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    found = suffix_dedup.suffix_dedup(docs, with_text=True, carry=tuple(rest), length=PASSAGE)
    trimmed = found.select(
        "doc_id", F.col("kept_text").alias("text"), *[F.col(f"carried.{c}") for c in rest]
    )
    return trimmed.withColumn("n_chars", F.length("text").cast("bigint")).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in training windows."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality),
    ("exact_dedup", exact),
    ("jaccard_join", near),
    ("suffix_dedup", passages),
    ("packing", pack),
]

# Passages that repeat and packing cannot be said in SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
