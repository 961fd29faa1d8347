"""Cutting ordered groups at a budget without sorting a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

FINE = 1 << 20
LIMIT = 1 << 17  # beyond the logarithm of the largest double


def digits(x: Column) -> tuple[Column, Column]:
    """Coarse and fine digit of a double; their pair ascends with ``x`` over the whole range of doubles.

    The digits are those of ``sign(x) * log2(1 + |x|)``, whose resolution follows the size of ``x``.
    """
    scaled = F.signum(x) * F.least(F.log2(1 + F.abs(x)) * 64, F.lit(float(LIMIT)))
    coarse = F.floor(scaled)
    return coarse, F.floor((scaled - coarse) * FINE)


def prefix_cut(rows: DataFrame, group: str, x: str, ties: Sequence[str], size: str, budgets: DataFrame) -> DataFrame:
    """Where each group, ordered by ``x`` and ``ties``, has to be cut to stay within its budget.

    ``budgets`` has one row ``(group, budget)`` per group. The result has one row per group with ``cut_coarse``,
    ``cut_fine``, ``cut_key`` and ``taken`` (total size of the prefix); ``within`` reads it. Radix selection: sizes
    are totalled by coarse digit, then by fine digit inside the coarse one that is crossed, and only the rows that
    share both digits are sorted. Rows must be stored, as they are read three times. Null ``x`` is not allowed.
    """
    coarse, fine = digits(F.col(x))
    rows = rows.select(F.col(group), F.col(x), *ties, F.col(size).alias("_size"), coarse.alias("_coarse"), fine.alias("_fine"))

    def crossing(cells: DataFrame, digit: str, limits: DataFrame) -> DataFrame:
        run = F.sum("_size").over(W.partitionBy(group).orderBy(digit))
        found = cells.withColumn("_run", run).join(limits, group)
        over = F.col("_run") > F.col("_left")
        return found.groupBy(group).agg(
            F.min(F.when(over, F.col(digit))).alias(f"cut{digit}"),
            F.max(F.when(~over, F.col("_run"))).alias("_before"), F.first("_left").alias("_left"))

    limits = budgets.select(group, F.col("budget").alias("_left"))
    first = crossing(rows.groupBy(group, "_coarse").agg(F.sum("_size").alias("_size")), "_coarse", limits)
    before = F.coalesce("_before", F.lit(0))
    first = first.select(group, "cut_coarse", before.alias("_taken"), (F.col("_left") - before).alias("_left"))
    cell = first.where("cut_coarse is not null").select(group, F.col("cut_coarse").alias("_coarse"), "_left")
    inner = rows.join(cell, [group, "_coarse"], "left_semi")
    second = crossing(inner.groupBy(group, "_fine").agg(F.sum("_size").alias("_size")), "_fine", cell.select(group, "_left"))
    second = second.select(group, "cut_fine", before.alias("_taken2"), (F.col("_left") - before).alias("_left2"))
    small = second.select(group, F.col("cut_fine").alias("_fine"), "_left2")
    last = inner.join(small, [group, "_fine"])
    run = F.sum("_size").over(W.partitionBy(group).orderBy(x, *ties).rowsBetween(W.unboundedPreceding, 0))
    last = last.withColumn("_run", run).where("_run <= _left2").groupBy(group).agg(
        F.max(F.struct(x, *ties)).alias("cut_key"), F.max("_run").alias("_taken3"))
    out = first.join(second, group, "left").join(last, group, "left")
    taken = sum((F.coalesce(c, F.lit(0)) for c in ("_taken", "_taken2", "_taken3")), F.lit(0))
    return out.select(group, "cut_coarse", "cut_fine", "cut_key", taken.alias("taken"))


def within(x: str, ties: Sequence[str]) -> Column:
    """Is the row before the cut of its group? For rows joined with the result of ``prefix_cut``."""
    coarse, fine = digits(F.col(x))
    at, at_fine = F.col("cut_coarse"), F.col("cut_fine")
    inside = F.coalesce(F.struct(x, *ties) <= F.col("cut_key"), F.lit(False))
    return at.isNull() | (coarse < at) | ((coarse == at) & ((fine < at_fine) | ((fine == at_fine) & inside)))
