"""The queries of this package and the SQL they are compared with."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm import licenses, mixing
from shelfline.llm import spans as S
from shelfline.llm.bpe import encode_documents
from shelfline.llm.divergence import quality_rules
from shelfline.llm.importance import resample
from shelfline.llm.near_dup import near_duplicates
from shelfline.llm.privacy import KINDS, sanitise
from shelfline.llm.rank_bpe import encode_ranked
from shelfline.llm.secrets import BASE, scan_secrets
from shelfline.llm.sketches import as_text, containment, distinct_shingles, fingerprints, resemblance
from shelfline.llm.token_count import count_tokens
from shelfline.llm.variants import variants
from shelfline.llm.whitening import whiten

Query = Callable[[SparkSession, str], DataFrame]
WORD_BPE = "word_bpe_49k.json"
BYTE_BPE = "byte_bpe_50k.json"
RANK_BPE = "byte_bpe_50k.tiktoken"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources weigh 3, 1, 2 in turn and share 150 % of all words, at most two copies of a document."""
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"),
                        F.col("_target").alias("target"), (F.col("_size") * F.col("_copies")).alias("taken"))


def op2_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log importance weight of every document and whether it is among the top k."""
    found = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "n_grams", "log_weight", "kept")


def op3_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))
    return encoded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op4_secret_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kinds = [r.kind for r in BASE]
    return found.select("doc_id", *[S.count_kind(F.col("_spans"), k).alias(f"n_{k}") for k in kinds],
                        F.sha2(S.listed(S.of_kinds(F.col("_spans"), kinds)), 256).alias("base_sha256"),
                        S.listed(F.col("_spans")).alias("spans"))


def op5_transducer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))


def op6_license_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licence a document is, and the licences of its paragraphs and lines."""
    found = licenses.scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    named = F.array_distinct(F.transform("_licenses", lambda x: x["license"]))
    places = F.transform("_licenses", lambda x: F.concat_ws(":", x["license"], x["unit"], x["position"].cast("string")))
    return found.select("doc_id", F.col("_whole").alias("whole_license"), F.array_join(named, ",").alias("licenses"),
                        F.size("_licenses").cast("long").alias("n_units"), F.array_join(places, ",").alias("places"))


def op7_bottom_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprints(table(spark, sf_dir, "documents"))
    own, edited, after = F.col("sketch"), F.col("edited_sketch"), F.col("next_sketch")
    return found.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), as_text(own).alias("fingerprint"),
        as_text(edited).alias("edited_fingerprint"), resemblance(own, edited).alias("near_edited"),
        resemblance(own, after).alias("near_next"), containment(own, edited).alias("contained_in_edited"),
        distinct_shingles(own).alias("distinct_shingles"))


def op8_distribution_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links at 85 % of three-word shingles."""
    return near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85).drop("tie")


def op10_private_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sanitise(table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = S.by_kind(F.col("_spans"))
    return found.select("doc_id", *[S.count_kind(F.col("_spans"), k).alias(f"n_{k}") for k in KINDS],
                        F.sha2(S.listed(S.of_kinds(spans, KINDS)), 256).alias("base_sha256"), S.listed(spans).alias("spans"))


def op11_fm_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(table(spark, sf_dir, "documents"))


def op12_blockmatrix_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each vector and each of its leading 16 components."""
    found = whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    rows = found.select("vec_id", "_n", "_deviation", "_identity_error", F.posexplode(F.arrays_zip("_whitened", "_explained")).alias("at", "c"))
    return rows.select("vec_id", (F.col("at") + 1).alias("component"), F.col("_n").alias("n"), F.col("_deviation").alias("deviation"),
                       F.col("c._whitened").alias("whitened"), F.col("c._explained").alias("explained"),
                       F.col("_identity_error").alias("identity_error"))


def op13_recursive_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encode_ranked(table(spark, sf_dir, "documents"), public_tokenizers.path(RANK_BPE))
    return encoded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_pareto_mix, op2_importance_resampling, op3_bpe_round_trip, op4_secret_index, op5_transducer_counts,
    op6_license_digests, op7_bottom_k, op8_distribution_rules, op9_near_dedup, op10_private_terms, op11_fm_variants,
    op12_blockmatrix_whitening, op13_recursive_bpe)}

SQL: dict[str, str] = {"op1_pareto_mix": mixing.MIX_SQL, "op6_license_digests": licenses.sql()}
