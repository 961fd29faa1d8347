"""Reproducible row sample."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.operators.ordered import smallest_rows


def sample_rows(df: DataFrame, n: int, seed: int = 42, key: Sequence[str] | None = None) -> DataFrame:
    """``n`` rows picked by a seeded MD5 of the row (or of ``key``): the same rows on every run and any engine."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (key or df.columns)]
    hashed = df.withColumn("_hash", F.md5(F.concat_ws("|", F.lit(str(seed)), *parts)))
    return smallest_rows(hashed, n, ["_hash"]).drop("_hash")
