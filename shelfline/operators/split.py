"""Chronological split and folds without a global sort.

Rows are ordered by date and, inside a date, by the tie columns. Row counts per date (bounded by the
calendar) locate the date of a cut; only that date's rows are ranked, block-wise.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from shelfline.operators.ordered import kth_smallest

TIES = ("store_id", "product_id")


def tie_key(tie: Sequence[str]) -> Column:
    """Comparable key of the tie columns, NULL before all values."""
    return F.struct(*[F.struct(F.col(t).isNotNull().alias("known"), F.col(t).alias("value")).alias(t) for t in tie])


@dataclass(frozen=True)
class Cut:
    """Position of the first ``rows`` rows in date and tie order."""

    rows: int
    date: object
    tie: tuple | None

    def before(self, date_col: str, tie: Sequence[str]) -> Column:
        """Condition that holds for exactly the first ``rows`` rows; rows without a date are the last."""
        if self.tie is None:
            return F.lit(False)
        d = F.col(date_col)
        same_day = tie_key(tie) <= F.struct(*[
            F.struct(F.lit(v.known).alias("known"), F.lit(v.value).alias("value")).alias(t) for t, v in zip(tie, self.tie)])
        if self.date is None:
            return d.isNotNull() | same_day
        return F.coalesce((d < F.lit(self.date)) | ((d == F.lit(self.date)) & same_day), F.lit(False))


def date_counts(df: DataFrame, date_col: str = "date") -> DataFrame:
    """Rows per date with the rows before it and the total, no date last; the window sees one row per date."""
    days = df.groupBy(date_col).agg(F.count(F.lit(1)).alias("n"))
    w = W.orderBy(F.col(date_col).asc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    return days.select(date_col, "n", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("before"),
                       F.sum("n").over(W.partitionBy()).alias("total"))


def find_cuts(df: DataFrame, positions: Sequence[int] | None, date_col: str = "date",
              tie: Sequence[str] = TIES, share: float | None = None) -> list[Cut]:
    """Cuts at row positions, or one at ``int(rows * share)``. One row per cut reaches the driver."""
    days = date_counts(df, date_col).persist()
    try:
        total = days.agg(F.max("total").alias("t")).first().t or 0
        wanted = [int(total * share)] if share is not None else list(positions)
        cuts = []
        for at in wanted:
            row = days.where((F.col("before") < at) & (F.col("before") + F.col("n") >= at)).first()
            if row is None:
                cuts.append(Cut(at, None, None))
                continue
            inside = at - row.before
            day = df.where(F.col(date_col).eqNullSafe(F.lit(row[date_col]).cast("date"))).select(tie_key(tie).alias("k"))
            last = kth_smallest(day, "k", F.lit(inside)).first().k
            cuts.append(Cut(at, row[date_col], tuple(last)))
        return cuts
    finally:
        days.unpersist()


def time_split(df: DataFrame, test_size: float = 0.2, date_col: str = "date",
               tie: Sequence[str] = TIES) -> tuple[DataFrame, DataFrame]:
    """First ``int(n * (1 - test_size))`` rows in time order for training, the others for testing."""
    first = find_cuts(df, None, date_col, tie, share=1 - test_size)[0].before(date_col, tie)
    return df.where(first), df.where(~first)


def split_report(train: DataFrame, test: DataFrame, date_col: str = "date") -> DataFrame:
    """Rows and date range of both parts."""
    def side(df, name):
        return df.agg(F.count(F.lit(1)).alias("row_count"), F.min(date_col).alias("first_date"),
                      F.max(date_col).alias("last_date")).select(F.lit(name).alias("part"), "row_count", "first_date", "last_date")
    return side(train, "train").unionByName(side(test, "test"))


def time_folds(df: DataFrame, folds: int, date_col: str = "date", tie: Sequence[str] = TIES,
               out: str = "fold") -> DataFrame:
    """Adds the number of the contiguous fold in time order; the first ``n % folds`` folds are one row longer."""
    n = df.count()
    sizes = [n // folds + (1 if i < n % folds else 0) for i in range(folds)]
    ends = [sum(sizes[:i + 1]) for i in range(folds - 1)]
    expr = F.lit(folds - 1)
    for i, cut in reversed(list(enumerate(find_cuts(df, ends, date_col, tie)))):
        expr = F.when(cut.before(date_col, tie), F.lit(i)).otherwise(expr)
    return df.withColumn(out, expr)
