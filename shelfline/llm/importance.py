"""Quality classifier by importance resampling over hashed n-grams.

Two bags of hashed token n-grams are counted: one over documents labelled good (target) and one over all documents
(raw). A document's weight is the likelihood ratio of the two models; a Gumbel number is added to its logarithm
and the top k are a sample without replacement in proportion to the weights.

Tokens are lower-cased runs of letters and digits or of other marks; the n-grams are single tokens and pairs, and
all immediate repetitions of a token are one pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm import flat
from shelfline.llm.cuts import prefix_cut, within
from shelfline.llm.mixing import uniform
from shelfline.session import materialize

BUCKETS = 1 << 14
_WORDY = np.zeros(256, np.uint8)  # 0 white space, 1 marks, 2 letters, digits and all beyond ASCII
_WORDY[:] = 1
_WORDY[flat.SPACE] = 0
_WORDY[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 2


def features(chunk: flat.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, document) of every n-gram of a chunk."""
    data = flat.LOWER[chunk.data]
    kind = _WORDY[data]
    edge = np.ones(len(kind) + 1, bool)
    edge[1:-1] = kind[1:] != kind[:-1]
    edge[chunk.bounds] = True
    at = np.flatnonzero(edge)
    starts, ends = at[:-1], at[1:]
    keep = kind[starts] > 0 if len(kind) else np.zeros(0, bool)
    starts, ends = starts[:len(keep)][keep], ends[:len(keep)][keep]
    hashes, docs = flat.range_hashes(data, starts, ends), flat.doc_of(starts, chunk.bounds)
    pairs = flat.mix(hashes[:-1] * np.uint64(0x9FB21C651E98DF25) + hashes[1:])
    pairs[hashes[:-1] == hashes[1:]] = 0
    inside = docs[:-1] == docs[1:]
    grams = np.r_[hashes, pairs[inside]] if len(hashes) else hashes
    return (grams >> np.uint64(50)).astype(np.int64), np.r_[docs, docs[:-1][inside]]


def count_models(good: np.ndarray):
    """mapInArrow function: (doc_id, text) to one row (bucket, target, raw) per bucket and task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target, seen = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64), False
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            liked = np.isin(np.nan_to_num(ids, nan=-1).astype(np.int64), good) & ~np.asarray(batch.column(0).is_null())
            for chunk in flat.chunks(batch.column(1)):
                bucket, docs = features(chunk)
                raw += np.bincount(bucket, minlength=BUCKETS)
                target += np.bincount(bucket[liked[chunk.first + docs]], minlength=BUCKETS)
                seen = True
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(BUCKETS)), pa.array(target), pa.array(raw)], names=["bucket", "target", "raw"])

    return run


def log_weights(ratio: np.ndarray):
    """mapInArrow function: (doc_id, tie, text) to (doc_id, tie, n_grams, log_weight)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in flat.chunks(batch.column(2)):
                bucket, docs = features(chunk)
                total = np.bincount(docs, weights=ratio[bucket], minlength=chunk.n)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(chunk.first, chunk.n), batch.column(1).slice(chunk.first, chunk.n),
                     pa.array(np.bincount(docs, minlength=chunk.n).astype(np.int64)), pa.array(np.round(total, 9))],
                    names=["doc_id", "tie", "n_grams", "log_weight"])

    return run


def importance_scores(docs: DataFrame, labels: DataFrame, label_bound: int = 20_000, smoothing: float = 1.0, seed: str = "gumbel",
                      id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, float]:
    """Stored (doc_id, tie, n_grams, log_weight, key, all) and the share of good documents among the labelled.

    The target model uses the ``label_bound`` labelled good ids with the smallest hashes; the raw model counts
    every document. ``labels``: doc_id, quality (1 good, 0 bad; null is no label).
    """
    flat.reachable(docs.sparkSession)
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("tie"),
                       F.col(text_col).alias("text"))
    known = labels.where("doc_id is not null and quality is not null")
    share = known.agg(F.avg(F.col("quality").cast("double"))).first()[0]
    chosen = known.where("quality = 1").select(F.col("doc_id").cast("long")).distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(label_bound)
    good = np.array(sorted(r[0] for r in chosen.collect()), np.int64)
    counts = base.select("doc_id", "text").mapInArrow(count_models(good), "bucket long, target long, raw long")
    target, raw = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for row in counts.groupBy("bucket").agg(F.sum("target"), F.sum("raw")).collect():  # BUCKETS rows at most
        target[row[0]], raw[row[0]] = row[1], row[2]
    ratio = np.log((target + smoothing) / (target.sum() + smoothing * BUCKETS)) - np.log((raw + smoothing) / (raw.sum() + smoothing * BUCKETS))
    if not len(good):
        ratio[:] = 0
    gumbel = -F.log(-F.log(uniform(seed, F.col("doc_id"))))
    scored = base.mapInArrow(log_weights(ratio), "doc_id long, tie long, n_grams long, log_weight double")
    # All rows are one group. Its key is stored like the scores: a literal would be folded, and the joins on it
    # would turn into nested loops.
    scored = scored.select("*", (F.col("log_weight") + gumbel).alias("key"), F.lit(0).alias("all"))
    return materialize(scored, "importance-scores"), 1.0 if share is None else share


def resample(docs: DataFrame, labels: DataFrame, rate: float | None = None, **options) -> DataFrame:
    """One row per document: ``doc_id, tie, n_grams, log_weight, kept``; the top ``rate`` of the rows are kept.

    ``rate`` is the share of good documents among the labelled ones if not given; without labels all rows are
    kept. Null text is empty: its weight is 1 (logarithm 0), as for any document without tokens. A null id draws
    as an empty id. Rows that repeat id and text have equal keys and stay or go together.
    """
    scored, share = importance_scores(docs, labels, **options)
    rate = share if rate is None else rate
    ranked = scored.withColumn("one", F.lit(1).cast("long")).withColumn("x", -F.col("key"))
    budgets = ranked.groupBy("all").agg((F.count(F.lit(1)) * rate).cast("double").alias("budget"))
    cut = prefix_cut(ranked, "all", "x", ["doc_id", "tie"], "one", budgets)
    kept = F.coalesce(within("x", ["doc_id", "tie"]), F.lit(False))
    return ranked.join(cut, "all").select("doc_id", "tie", "n_grams", "log_weight", kept.alias("kept"))
