"""Document fingerprints: bottom-k sketches of shingle hashes, with built-in functions only.

A sketch is the ascending array of the ``k`` smallest distinct 48-bit hashes of a document's word shingles. The
sketch of a union is the k smallest values of the two sketches, so sketches merge across parts. Two sketches
estimate resemblance and containment; one estimates the number of distinct shingles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfline.session import materialize

K = 128
HASH_BITS = 48
WORDS = 5


def with_sketch(df: DataFrame, text_col: str, out: str, k: int = K, words: int = WORDS) -> DataFrame:
    """``df`` with the sketch of ``text_col``.

    Words are runs of characters that are not ASCII white space. A text of fewer than ``words`` words has its whole
    sequence as the only shingle; null or a text without words gives an empty sketch.
    """
    split = F.split(F.coalesce(F.col(text_col), F.lit("")), r"[\x20\x09-\x0D]+", -1)
    df = df.withColumn("_words", F.array_remove(split, ""))
    df = df.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w))).drop("_words")
    n = F.size("_hashes")
    # The window at i is hashed from the hashes of its words.
    windows = F.transform(F.sequence(F.lit(0), n - words), lambda i: F.xxhash64(*[F.get("_hashes", i + j) for j in range(words)]))
    whole = F.array(F.xxhash64("_hashes"))
    grams = F.when(n >= words, windows).when(n > 0, whole).otherwise(F.array().cast("array<bigint>"))
    df = df.withColumn("_grams", grams).drop("_hashes")
    small = F.transform("_grams", lambda h: F.shiftrightunsigned(h, 64 - HASH_BITS))
    return df.withColumn(out, F.slice(F.sort_array(F.array_distinct(small)), 1, k)).drop("_grams")


def merge(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the union of two shingle sets."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity; exact if both sets have fewer than ``k`` shingles. Two empty sets: 1."""
    union = F.sort_array(F.array_union(a, b))
    complete = (F.size(a) < k) & (F.size(b) < k)
    least = F.when(complete, union).otherwise(F.slice(union, 1, k))
    shared = F.size(F.array_intersect(F.array_intersect(a, b), least))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(shared / F.greatest(F.size(least), F.lit(1)))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below ``k``."""
    kth = F.greatest(F.coalesce(F.get(a, F.lit(k - 1)), F.lit(1)), F.lit(1)).cast("double")
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) * float(1 << HASH_BITS) / kth)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the shingles of ``a`` that ``b`` has; 1 if ``a`` has none."""
    j, na, nb = resemblance(a, b, k), distinct_shingles(a, k), distinct_shingles(b, k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), j * (na + nb) / ((1 + j) * F.greatest(na, F.lit(1.0)))))


def as_text(sketch: Column) -> Column:
    """Sketch as a string of 12 hexadecimal digits a value."""
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.lower(F.hex(h)), HASH_BITS // 4, "0")), "")


def _block(bounds: list[int], x: Column) -> Column:
    """Number of ``bounds`` (ascending) that are at most ``x``, by bisection."""
    if not bounds:
        return F.lit(0)
    table = F.array(*[F.lit(int(b)) for b in bounds])

    def halve(acc: Column, _: Column) -> Column:
        mid = F.floor((acc["lo"] + acc["hi"]) / 2).cast("int")
        below = F.coalesce(F.get(table, mid) <= x, F.lit(True))
        wide = acc["lo"] < acc["hi"]
        return F.struct(F.when(wide & below, mid + 1).otherwise(acc["lo"]).alias("lo"),
                        F.when(wide & ~below, mid).otherwise(acc["hi"]).alias("hi"))

    start = F.struct(F.lit(0).alias("lo"), F.lit(len(bounds)).alias("hi"))
    steps = F.sequence(F.lit(0), F.lit(len(bounds).bit_length()))
    return F.aggregate(steps, start, halve, lambda acc: acc["lo"])


def dealt_in_order(docs: DataFrame, order: list[str], blocks: int | None = None) -> DataFrame:
    """``docs`` in blocks that follow each other by ``order`` (a number, then ties), each with the head of the next.

    Adds ``_block`` and ``_guest``: rows are dealt between quantiles of the first order column, and the first row
    of every block visits the block before it (that of the first block the last one).
    """
    spark = docs.sparkSession
    if blocks is None:
        blocks = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    first = order[0]
    narrow = materialize(docs.select(*order), "order")
    shares = [i / blocks for i in range(1, blocks)]
    cuts = narrow.agg(F.percentile_approx(first, shares, 100 * blocks)).first()[0] if shares else None
    cuts = sorted(set(cuts or []))  # as many numbers as there are blocks
    block = F.when(F.col(first).isNull(), F.lit(len(cuts))).otherwise(_block(cuts, F.col(first))).cast("int")
    key = F.struct(F.col(first).isNull().alias("none"), *order)
    heads = narrow.withColumn("_own", block).groupBy("_own").agg(F.min(key).alias("head"))
    around = W.orderBy("_own")  # one row a block
    back = F.coalesce(F.lag("_own").over(around), F.max("_own").over(W.partitionBy()))
    heads = heads.select(back.alias("_block"), *[F.col(f"head.{c}").alias(f"_h{i}") for i, c in enumerate(order)])
    heads = materialize(heads, "heads")
    cond = F.lit(True)
    for i, c in enumerate(order):
        cond = cond & F.col(c).eqNullSafe(F.col(f"_h{i}"))
    guests = docs.join(heads, cond).dropDuplicates([f"_h{i}" for i in range(len(order))])
    guests = guests.select(*docs.columns, "_block", F.lit(True).alias("_guest"))
    return docs.withColumn("_block", block).withColumn("_guest", F.lit(False)).unionByName(guests)


def with_next(dealt: DataFrame, order: list[str], values: list[str]) -> DataFrame:
    """The rows of ``dealt_in_order`` with ``next_<value>`` of the following row; the last sees the first.

    No task sorts the whole table, and texts are shuffled once. Nulls come last. Rows equal in all of ``order``
    follow each other in any order.
    """
    w = W.partitionBy("_block").orderBy("_guest", F.col(order[0]).isNull(), *order)
    out = dealt.select("*", *[F.lead(v).over(w).alias(f"next_{v}") for v in values])
    return out.where(~F.col("_guest")).drop("_guest", "_block")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K) -> DataFrame:
    """Every document with its sketch, its edited text with that text's sketch, and the next document's sketch.

    The edited text has its last floor(n / 2) code points replaced by the first as many of the next document by
    ascending id (nulls last, ties by a hash of the text); the last document is followed by the first, a single
    one by itself. Null text is empty. Columns: id, ``n_chars, sketch, edited, edited_sketch, next_sketch``.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("tie"))
    order = ["doc_id", "tie"]
    paired = with_next(with_sketch(dealt_in_order(base, order), "text", "sketch", k), order, ["text", "sketch"])
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.length("text") - half), F.substring(F.col("next_text"), F.lit(1), half))
    paired = paired.select("doc_id", F.length("text").cast("long").alias("n_chars"), "sketch", edited.alias("edited"),
                           F.col("next_sketch"))
    return with_sketch(paired, "edited", "edited_sketch", k)
