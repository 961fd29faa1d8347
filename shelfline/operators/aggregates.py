"""Aggregations of the sales fact."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def daily_sales_agg(sales: DataFrame) -> DataFrame:
    """Day, store and product totals; transactions are counted, not made distinct."""
    return sales.groupBy("date", "store_id", "product_id").agg(
        F.sum("quantity").alias("daily_quantity"),
        F.sum("total_amount").alias("daily_revenue"),
        F.count("transaction_id").alias("transaction_count"),
        F.sum(F.col("discount_applied").cast("int")).alias("discounted_count"))


def distinct_count(column: str, approximate: bool = False) -> Column:
    """Exact distinct count; the sketch is an explicit choice of the caller."""
    return F.approx_count_distinct(column) if approximate else F.count_distinct(column)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) for every table."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def total_by(df: DataFrame, keys: Sequence[str], **sums: str) -> DataFrame:
    """Plain sums by key, named ``out=column``."""
    return df.groupBy(*keys).agg(*[F.sum(c).alias(out) for out, c in sums.items()])


def with_distinct_counts(df: DataFrame, keys: Mapping[str, Column], sums: Mapping[str, Column],
                         distinct: Mapping[str, str]) -> DataFrame:
    """One row per key with sums and exact distinct counts (``out=column``).

    Several distinct counts in one aggregate copy every row once for each of them before the shuffle. Here every
    counted column has an aggregate of its own straight over the scan, which reads that column and the keys only and
    combines equal (key, value) pairs before its shuffle; the sums go with the first. The results, one row per key,
    are joined. NULL keys are keys.
    """
    counts: dict[str, list[str]] = {}
    for out, column in distinct.items():
        counts.setdefault(column, []).append(out)
    parts = []
    for column, outs in counts.items():
        own = {} if parts else sums
        rows = df.select(*[c.alias(k) for k, c in keys.items()], F.col(column).alias("_of"), *[c.alias(n) for n, c in own.items()])
        counted = rows.groupBy(*keys).agg(*[F.sum(n).alias(n) for n in own], F.count_distinct("_of").alias("_n"))
        parts.append(counted.select(*keys, *own, *[F.col("_n").alias(o) for o in outs]))
    total = parts[0]
    for part in parts[1:]:
        part = part.withColumnsRenamed({k: f"_{k}" for k in keys})
        cond = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
        total = total.join(part, cond).drop(*[f"_{k}" for k in keys])
    return total
