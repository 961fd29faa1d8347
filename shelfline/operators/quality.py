"""Data-quality checks. Each returns (check_name, issue_count) rows, one pass per table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.operators.ordered import exact_percentiles


class QualityError(ValueError):
    """A check found issues."""


def _long(row: DataFrame) -> DataFrame:
    """One wide row of counts to (check_name, issue_count) rows."""
    return row.unpivot([], row.columns, "check_name", "issue_count")


def all_checks(checks: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def assert_clean(checks: DataFrame) -> DataFrame:
    """Raise one error that names every failing check (a handful of rows reach the driver)."""
    bad = checks.where(F.col("issue_count") > 0).orderBy("check_name").collect()
    if bad:
        raise QualityError("; ".join(f"{r.check_name}: {r.issue_count}" for r in bad))
    return checks


def require_columns(df: DataFrame, columns: Sequence[str], name: str = "frame") -> DataFrame:
    """The frame itself, or one error that names all missing columns."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise QualityError(f"{name}: missing columns {missing}")
    return df


def count_where(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """Rows that meet each named condition, in one aggregation."""
    return _long(df.agg(*[F.count_if(c).alias(n) for n, c in conditions.items()]))


def known_counts(spark: SparkSession, counts: Mapping[str, int]) -> DataFrame:
    """Check rows of counts that another pass has taken."""
    return _long(spark.range(1).select(*[F.lit(n).cast("long").alias(name) for name, n in counts.items()]))


def dq_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return count_where(df, {f"null_{c}": F.col(c).isNull() for c in columns})


def dq_negative(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return count_where(df, {f"negative_{c}": F.col(c) < 0 for c in columns})


def dq_duplicate_keys(df: DataFrame, key: str | Sequence[str], name: str = "duplicate_keys") -> DataFrame:
    """Rows beyond the distinct keys; rows with a NULL key count too."""
    keys = [key] if isinstance(key, str) else list(key)
    return _long(df.agg((F.count(F.lit(1)) - F.count_distinct(*keys)).alias(name)))


def dq_orphans(fact: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None,
               name: str | None = None) -> DataFrame:
    """Fact rows whose key has no dimension row (NULL keys included).

    Keys are counted before the anti-join, so a key that holds most rows is one row there.
    """
    counted = fact.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    keys = dim.select(F.col(dim_key or key).alias("_k"))
    lost = counted.join(keys, F.col(key) == F.col("_k"), "left_anti")
    return _long(lost.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias(name or f"orphaned_{key}s")))


@dataclass(frozen=True)
class Range:
    """Allowed values; each end belongs to them unless it is open."""

    low: object
    high: object
    low_open: bool = False
    high_open: bool = False

    def outside(self, c: Column) -> Column:
        below = c <= F.lit(self.low) if self.low_open else c < F.lit(self.low)
        above = c >= F.lit(self.high) if self.high_open else c > F.lit(self.high)
        return below | above


def dq_bounds(df: DataFrame, ranges: Mapping[str, tuple | Range], quantiles: Mapping[str, tuple[float, float]] | None = None) -> DataFrame:
    """Rows outside their range per column, and per quantile rule 1 when it is not below its limit.

    A pair is a range with both ends. NULL is not outside: ``dq_nulls`` counts it.
    """
    rules = {c: r if isinstance(r, Range) else Range(*r) for c, r in ranges.items()}
    checks = [count_where(df, {f"{c}_out_of_range": r.outside(F.col(c)) for c, r in rules.items()})]
    for c, (p, limit) in (quantiles or {}).items():
        row = exact_percentiles(df.select(c), c, [p], ["q"])
        over = F.coalesce(F.col("q") >= limit, F.lit(False)).cast("long")
        checks.append(_long(row.select(over.alias(f"{c}_q{round(p * 100)}_too_high"))))
    return all_checks(checks)


def dq_completeness(tables: Mapping[str, DataFrame | None], least_rows: Mapping[str, int],
                    span: tuple[str, str, int] | None = None) -> DataFrame:
    """1 for every missing table, table with too few rows, or too short date span, else 0."""
    some = next(t for t in tables.values() if t is not None)
    checks = []
    for name in sorted(set(tables) | set(least_rows)):
        df = tables.get(name)
        if df is None:
            one = some.sparkSession.range(1).select(F.lit(1).cast("long").alias(f"missing_{name}"))
            checks.append(_long(one))
            continue
        short = (F.count(F.lit(1)) < least_rows.get(name, 1)).cast("long")
        checks.append(_long(df.agg(short.alias(f"too_few_{name}"))))
    if span is not None and tables.get(span[0]) is not None:
        table, column, days = span
        length = F.coalesce(F.datediff(F.max(column), F.min(column)), F.lit(-1))
        checks.append(_long(tables[table].agg((length < days).cast("long").alias(f"short_span_{table}"))))
    return all_checks(checks)


def dq_profile(df: DataFrame) -> DataFrame:
    """Per column its type, the row count and the number of missing values, in one pass."""
    row = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    kinds = F.create_map(*[F.lit(x) for c, k in df.dtypes for x in (c, k)])
    return row.unpivot(["_rows"], df.columns, "column_name", "missing").select(
        "column_name", kinds[F.col("column_name")].alias("data_type"), F.col("_rows").alias("row_count"), "missing")


def dq_price_gt_cost(products: DataFrame) -> DataFrame:
    ok = F.coalesce(F.col("unit_price") > F.col("unit_cost"), F.lit(False))
    return count_where(products, {"price_not_above_cost": ~ok})
