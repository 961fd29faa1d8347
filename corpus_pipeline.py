"""From raw documents to token ids: quality, near duplicates, secrets, mixing, tokens.

Each stage works on all its predecessor kept. Null ids and texts, repeated rows and empty tables are handled as the
operators state; a row is followed through a stage by its id and a hash of its text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm import spans
from shelfline.llm.bpe import encode_documents
from shelfline.llm.columns import free
from shelfline.llm.importance import resample
from shelfline.llm.mixing import mix
from shelfline.llm.near_dup import near_duplicates
from shelfline.llm.secrets import scan_secrets
from shelfline.session import materialize


def _only(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose (doc_id, tie) is in ``kept``."""
    kept = kept.select(F.col("doc_id").alias("_id"), F.col("tie").alias("_tie"))
    tie = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["_id"]) & (tie == kept["_tie"]), "left_semi")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Importance resampling towards the documents labelled good; as large a share stays as is labelled good."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return _only(docs, resample(docs, labels).where("kept"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: five-word shingles, similarity 0.8."""
    kept = _only(docs, near_duplicates(docs).where("kept"))
    tie = free("_tie", docs.columns)
    return kept.withColumn(tie, F.xxhash64(F.coalesce("text", F.lit("")))).dropDuplicates(["doc_id", tie]).drop(tie)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are cut out of the texts, which keep all else; ``n_chars`` follows."""
    found, name = scan_secrets(docs), free("_spans", docs.columns)
    clean = spans.replaced(F.col("text"), F.col(name), lambda s: F.lit("[SECRET]"))
    found = found.withColumn("text", clean).drop(name)
    return found.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it, one row a copy."""
    copies = F.col(free("_copies", docs.columns))
    each = F.explode(F.sequence(F.lit(1).cast("long"), copies)).alias(free("_copy", docs.columns))
    return mix(docs).where(copies > 0).select(*docs.columns, each).select(docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, with digests of the ids and of the text they decode to."""
    return encode_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality classifier", quality), ("near dedup", near_dedup), ("secret scan", secrets), ("source mix", mixing), ("tokens", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)


# Hashed n-grams, signatures and merges are not SQL: the stages are tested against brute force.
ORACLE_SQL = None
