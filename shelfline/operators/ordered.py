"""Order statistics over groups too large for one task.

A window without partition keys, or over a group that holds most rows, runs in a single task. The
functions here split the value range into blocks instead: equal values are first collapsed into one
row with a count, every block is sorted on its own, and the counts of the blocks before it (about one
row per shuffle partition and group) supply the offset.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def block_count(df: DataFrame) -> int:
    """As many blocks as the session shuffles into partitions."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2)


def null_safe(left: DataFrame, right: DataFrame, cols: Sequence[str]) -> Column:
    """Equi-join condition on ``cols`` in which NULL matches NULL."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & left[c].eqNullSafe(right[c])
    return cond


def range_cuts(df: DataFrame, key: str, n: int | None = None) -> Column:
    """Sorted array of at most ``n`` cut points of ``key``, as a scalar subquery.

    The cuts are the distinct keys with the smallest hashes: an even sample that depends only on the
    data, so every branch of a plan sees the same blocks.
    """
    sample = (df.select(F.col(key).alias("k")).where(F.col("k").isNotNull()).distinct()
              .orderBy(F.xxhash64("k"), "k").limit(n or block_count(df)))
    return sample.agg(F.sort_array(F.collect_list("k")).alias("cuts")).scalar()


def block_of(key: Column, cuts: Column) -> Column:
    """Number of cut points below ``key``; NULL keys fall into block -1."""
    return F.when(key.isNull(), F.lit(-1)).otherwise(F.size(F.filter(cuts, lambda c: c < key)))


def order_stats(df: DataFrame, key: str, by: Sequence[str] = (), sums: Sequence[str] = (),
                cuts: int | None = None) -> DataFrame:
    """One row per (``by``, ``key``) with totals over the rows at or below that key.

    Columns: ``n_here``, ``n_le``, ``n_all`` (rows), ``d_le``, ``d_all`` (distinct keys) and for each
    column of ``sums`` ``<c>_here``, ``<c>_le``, ``<c>_all``. NULL keys sort before all others.
    """
    by = list(by)
    measures = {"n": F.count(F.lit(1)), **{s: F.sum(s) for s in sums}}
    vals = df.groupBy(*by, key).agg(*[m.alias(f"{k}_here") for k, m in measures.items()])
    vals = vals.withColumn("_cuts", range_cuts(df, key, cuts))
    vals = vals.withColumn("_block", block_of(F.col(key), F.col("_cuts"))).drop("_cuts")

    totals = {k: F.sum(f"{k}_here") for k in measures}
    totals["d"] = F.count(F.lit(1))
    blocks = vals.groupBy(*by, "_block").agg(*[t.alias(f"{k}_blk") for k, t in totals.items()])
    whole = W.partitionBy(*by)
    before = whole.orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    offsets = blocks.select(
        *by, "_block",
        *[F.sum(f"{k}_blk").over(before).alias(f"{k}_off") for k in totals],
        *[F.sum(f"{k}_blk").over(whole).alias(f"{k}_all") for k in totals])

    inside = W.partitionBy(*by, "_block").orderBy(F.col(key).asc_nulls_first())
    inside = inside.rowsBetween(W.unboundedPreceding, W.currentRow)
    running = {k: F.sum(f"{k}_here").over(inside) for k in measures}
    running["d"] = F.count(F.lit(1)).over(inside)
    local = vals.select(*by, key, "_block", *[f"{k}_here" for k in measures],
                        *[r.alias(f"{k}_run") for k, r in running.items()])
    # The block number is never NULL: plain equality keeps the partitioning of the window.
    joined = local.join(offsets, (local["_block"] == offsets["_block"]) & null_safe(local, offsets, by))
    zero = F.lit(0)
    return joined.select(
        *[local[c] for c in by], local[key], *[f"{k}_here" for k in measures],
        *[(F.coalesce(F.col(f"{k}_off"), zero) + F.coalesce(F.col(f"{k}_run"), zero)).alias(f"{k}_le")
          for k in totals],
        *[f"{k}_all" for k in totals])


def exact_percentiles(df: DataFrame, value: str, probabilities: Sequence[float],
                      names: Sequence[str]) -> DataFrame:
    """One row with continuous percentiles (linear interpolation) of ``value``, computed exactly."""
    stats = order_stats(df.where(F.col(value).isNotNull()).select(value), value)
    last = F.col("n_all") - 1
    aggs = []
    for p, name in zip(probabilities, names):
        at = F.lit(p) * last
        aggs += [F.min(F.when(F.col("n_le") > F.floor(at), F.col(value))).cast("double").alias(f"{name}_lo"),
                 F.min(F.when(F.col("n_le") > F.ceil(at), F.col(value))).cast("double").alias(f"{name}_hi"),
                 F.max(at - F.floor(at)).alias(f"{name}_w")]
    row = stats.agg(*aggs)
    return row.select(*[
        (F.col(f"{n}_lo") + (F.col(f"{n}_hi") - F.col(f"{n}_lo")) * F.col(f"{n}_w")).alias(n) for n in names])


def kth_smallest(df: DataFrame, key: str, k: Column) -> DataFrame:
    """One row holding the ``k``-th smallest ``key`` (1-based; NULL when ``k`` is 0)."""
    stats = order_stats(df.select(key), key)
    return stats.agg(F.min(F.when((F.col("n_le") >= k) & (k > 0), F.col(key))).alias(key))


# Rows that one task may hold and sort.
TOP_ROWS = 100_000


def smallest_rows(df: DataFrame, n: int, order_by: Sequence[str]) -> DataFrame:
    """The first ``n`` rows in the order of the given columns, NULL first.

    Up to ``TOP_ROWS`` rows are a top-n: every task keeps ``n`` rows at most. For more, the n-th key is located and the
    rows are filtered by it, so they stay where they are; only of the rows equal to it in every order column some
    are cut.
    """
    if n <= TOP_ROWS:
        return df.orderBy(*order_by).limit(n)
    key = F.struct(*[F.struct(F.col(c).isNotNull().alias("known"), F.col(c).alias("value")).alias(c) for c in order_by])
    keyed = df.withColumn("_key", key)
    last = kth_smallest(keyed, "_key", F.lit(n)).first()["_key"]
    if last is None:  # fewer than n rows
        return df if n > 0 else df.limit(0)
    at = F.struct(*[F.struct(F.lit(v.known).alias("known"), F.lit(v.value).cast(df.schema[c].dataType).alias("value")).alias(c)
                    for c, v in zip(order_by, last)])
    below = keyed.where(F.col("_key") < at).drop("_key")
    return below.unionByName(keyed.where(F.col("_key") == at).drop("_key").limit(n - below.count()))


# ---------------------------------------------------------------------------------------------
# Ranking operators. NULL values rank last in either direction. ``of`` is a stored frame with the same
# values, from which the statistics are taken: without it, a chain of these operators would compute
# each link twice.


def _join_stats(df: DataFrame, stats: DataFrame, keys: Sequence[str], add: dict[str, Column]) -> DataFrame:
    extra = stats.select(*[F.col(k).alias(f"_k_{k}") for k in keys],
                         *[c.alias(n) for n, c in add.items()])
    cond = F.lit(True)
    for k in keys:
        cond = cond & df[k].eqNullSafe(extra[f"_k_{k}"])
    return df.join(extra, cond, "left").drop(*[f"_k_{k}" for k in keys])


def add_rank(df: DataFrame, value: str, out: str, by: Sequence[str] = (), dense: bool = False,
             of: DataFrame | None = None) -> DataFrame:
    """RANK or DENSE_RANK by ``value`` descending, inside ``by``."""
    unit = "d" if dense else "n"
    rank = F.col(f"{unit}_all") - F.col(f"{unit}_le") + 1
    return _join_stats(df, order_stats(of or df, value, by), [*by, value], {out: rank})


def add_percent_rank(df: DataFrame, value: str, out: str, of: DataFrame | None = None) -> DataFrame:
    """PERCENT_RANK by ``value`` ascending, NULL last."""
    key = F.struct(F.col(value).isNull().alias("z"), F.col(value).alias("v"))
    below = F.col("n_le") - F.col("n_here")
    share = F.when(F.col("n_all") > 1, below / (F.col("n_all") - 1)).otherwise(F.lit(0.0))
    stats = order_stats((of or df).withColumn("_key", key), "_key")
    return _join_stats(df.withColumn("_key", key), stats, ["_key"], {out: share}).drop("_key")


def add_ntile(df: DataFrame, value: str, tie: str, tiles: int, out: str, of: DataFrame | None = None) -> DataFrame:
    """NTILE by ``value`` descending with the unique column ``tie`` deciding equal values."""
    key = F.struct(F.col(value).isNull().alias("z"), (-F.col(value)).alias("v"), F.col(tie).alias("t"))
    # The first (rows % tiles) tiles hold one row more than the others.
    at, base, more = F.col("n_le") - 1, F.floor(F.col("n_all") / tiles), F.col("n_all") % tiles
    big = more * (base + 1)
    tile = F.when(at < big, F.floor(at / (base + 1))).otherwise(more + F.floor(F.try_divide(at - big, base)))
    stats = order_stats((of or df).withColumn("_key", key), "_key")
    return _join_stats(df.withColumn("_key", key), stats, ["_key"], {out: tile.cast("long") + 1}).drop("_key")


def add_running_total(df: DataFrame, value: str, out: str, total: str, of: DataFrame | None = None) -> DataFrame:
    """Running sum of ``value`` from the largest down (equal values share it) and the grand total.

    NULL values come last and carry the full sum.
    """
    zero = F.lit(0)
    run = F.col("_v_all") - F.coalesce("_v_le", zero) + F.coalesce("_v_here", zero)
    stats = order_stats((of or df).withColumn("_v", F.col(value)), value, sums=["_v"])
    return _join_stats(df, stats, [value], {out: run, total: F.col("_v_all")})
