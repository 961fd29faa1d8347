"""Label codes for categorical columns, kept as dictionary tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.operators.ordered import order_stats
from shelfline.session import materialize


@dataclass
class LabelCodes:
    """One (label, code) table per column; codes count up from 0 in label order."""

    tables: dict[str, DataFrame]

    def transform(self, df: DataFrame, suffix: str = "_code") -> DataFrame:
        """Adds ``<column>_code``; a label that was not seen when fitting gets code 0."""
        for column, table in self.tables.items():
            codes = table.select(F.col("label").alias("_label"), F.col("code").alias("_code"))
            df = (df.join(codes, F.col(column).cast("string") == F.col("_label"), "left")
                  .withColumn(f"{column}{suffix}", F.coalesce("_code", F.lit(0))).drop("_label", "_code"))
        return df

    def save(self, path: str) -> None:
        for column, table in self.tables.items():
            table.write.mode("overwrite").parquet(f"{path}/{column}")

    @staticmethod
    def load(spark: SparkSession, path: str, columns: Sequence[str]) -> "LabelCodes":
        return LabelCodes({c: spark.read.schema("label STRING, code LONG").parquet(f"{path}/{c}") for c in columns})


def fit_label_codes(df: DataFrame, columns: Sequence[str]) -> LabelCodes:
    """Codes by label order, computed block-wise so that a column with very many labels works too."""
    tables = {}
    for c in columns:
        labels = df.select(F.col(c).cast("string").alias("label")).where(F.col("label").isNotNull())
        ranked = order_stats(materialize(labels.distinct(), "labels"), "label")
        tables[c] = ranked.select("label", (F.col("d_le") - 1).alias("code"))
    return LabelCodes(tables)
