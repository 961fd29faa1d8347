"""Join patterns of the reports and checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def star_join(sales: DataFrame, stores: DataFrame, products: DataFrame) -> DataFrame:
    """Fact with its store and product attributes; rows without a match drop out."""
    return (sales.join(stores.select("store_id", "region", "store_format"), "store_id")
            .join(products.select("product_id", "category", "subcategory"), "product_id"))


def preserve_dimension(dim: DataFrame, fact: DataFrame, key: str, **aggs: Column) -> DataFrame:
    """Every dimension row with aggregates of its fact rows, NULL where there are none.

    The fact is aggregated first: the join meets one row per key however hot a key is.
    """
    totals = fact.groupBy(key).agg(*[a.alias(n) for n, a in aggs.items()])
    return dim.join(totals, key, "left")


def with_group_mean(df: DataFrame, group: str, value: str, out: str) -> DataFrame:
    """Each row beside the mean of its group, by joining the group aggregate."""
    means = df.groupBy(group).agg(F.try_divide(F.sum(value).cast("double"), F.count(value)).alias(out))
    return df.join(means, group)


def with_grand_total(df: DataFrame, value: str, out: str) -> DataFrame:
    """Each row beside the grand total, as a scalar subquery."""
    return df.withColumn(out, df.agg(F.sum(value).alias("t")).scalar())


def orphans(fact: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """Fact rows without a dimension row; a NULL key has none."""
    keys = dim.select(F.col(dim_key or key).alias("_k"))
    return fact.join(keys, F.col(key) == F.col("_k"), "left_anti")


def missing_keys(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Distinct key values of ``fact`` that ``dim`` lacks."""
    return fact.select(key).subtract(dim.select(key))


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by name; columns a frame lacks become NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
