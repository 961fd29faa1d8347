"""Incremental load: filter, checks, upsert, watermark and log."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline import schemas
from shelfline.operators.aggregates import row_counts
from shelfline.operators.quality import all_checks, assert_clean, count_where, dq_duplicate_keys, dq_orphans, known_counts
from shelfline.session import materialize_observed
from shelfline.sources import versions
from shelfline.sources.tables import path_exists

START_DATE = "1900-01-01"
UPDATED_ON_CONFLICT = ["quantity", "total_amount", "discount_percent"]
REQUIRED = ["transaction_id", "date", "store_id", "product_id"]


def initial_watermark(spark: SparkSession, table: str) -> DataFrame:
    return spark.range(1).select(
        F.lit(table).alias("table_name"), F.lit(START_DATE).cast("date").alias("last_loaded_date"),
        F.lit(0).cast("long").alias("last_loaded_id"), F.current_timestamp().alias("updated_at"))


def read_watermark(spark: SparkSession, path: str, table: str) -> DataFrame:
    """The newest stored watermark of the table, or the initial one."""
    if not path_exists(spark, path):
        return initial_watermark(spark, table)
    stored = spark.read.schema(schemas.WATERMARKS).parquet(path).where(F.col("table_name") == table)
    latest = stored.orderBy(F.col("updated_at").desc(), F.col("last_loaded_id").desc()).limit(1)
    return latest if not latest.isEmpty() else initial_watermark(spark, table)


def incremental_filter(source: DataFrame, watermark: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Rows with a key above the watermark; the scalar subquery is pushed down as a plain comparison."""
    last = watermark.agg(F.coalesce(F.max("last_loaded_id"), F.lit(0)).alias("id")).scalar()
    return source.where(F.col(key) > last)


def any_null(columns: Sequence[str]) -> Column:
    found = F.lit(False)
    for c in columns:
        found = found | F.col(c).isNull()
    return found


def stage(rows: DataFrame, required: Sequence[str] = REQUIRED, key: str = "transaction_id") -> tuple[DataFrame, dict]:
    """The rows stored for a load, with what the pass that wrote them saw: their number, the rows that lack a required
    value, the last date and the last key."""
    return materialize_observed(rows, "staged", rows=F.count(F.lit(1)), null_required=F.count_if(any_null(required)),
                                last_date=F.max("date"), last_key=F.max(key).cast("long"))


def staging_checks(staged: DataFrame, stores: DataFrame | None = None, products: DataFrame | None = None,
                   required: Sequence[str] = REQUIRED, key: str = "transaction_id",
                   fail_on_issue: bool = True, seen: dict | None = None) -> DataFrame:
    """Required values, foreign keys and key uniqueness of the staged rows; ``seen`` is what ``stage`` saw of them."""
    nulls = (known_counts(staged.sparkSession, {"null_required": seen["null_required"]}) if seen
             else count_where(staged, {"null_required": any_null(required)}))
    checks = [nulls, dq_duplicate_keys(staged, key)]
    if stores is not None:
        checks.append(dq_orphans(staged, stores, "store_id"))
    if products is not None:
        checks.append(dq_orphans(staged, products, "product_id"))
    result = all_checks(checks)
    return assert_clean(result) if fail_on_issue else result


def upsert(target: DataFrame, staged: DataFrame, key: str | Sequence[str],
           update_columns: Sequence[str] = UPDATED_ON_CONFLICT) -> DataFrame:
    """New keys are added; of known keys only ``update_columns`` change, to the staged value even if NULL."""
    keys = [key] if isinstance(key, str) else list(key)
    old = target.withColumn("_old", F.lit(True)).alias("o")
    new = staged.withColumn("_new", F.lit(True)).alias("n")
    cond = F.lit(True)
    for k in keys:
        cond = cond & (F.col(f"o.{k}") == F.col(f"n.{k}"))
    out = []
    for c in target.columns:
        o, n = F.col(f"o.{c}"), F.col(f"n.{c}")
        take_new = F.col("n._new") if c in update_columns else F.col("o._old").isNull()
        out.append(F.when(take_new, n).otherwise(o).cast(target.schema[c].dataType).alias(c))
    return old.join(new, cond, "full_outer").select(*out)


def merge_into(spark: SparkSession, path: str, staged: DataFrame, key: str,
               update_columns: Sequence[str], partition_col: str) -> None:
    """Upsert into a table of whole states: one join of the table with the stage by key, written as the next state.

    A run that fails leaves the table as it was, and repeating a merge gives the same table.
    """
    if not versions.exists(spark, path):
        return versions.replace(staged, path, partition_col)
    versions.replace(upsert(versions.read(spark, path).select(*staged.columns), staged, key, update_columns), path, partition_col)


def watermark_update(staged: DataFrame, watermark: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Last date and key of the staged rows; an empty stage keeps the old values."""
    top = staged.agg(F.max("date").alias("_d"), F.max(key).cast("long").alias("_k"))
    return watermark.select(
        "table_name",
        F.coalesce(top.select("_d").scalar(), F.col("last_loaded_date")).alias("last_loaded_date"),
        F.coalesce(top.select("_k").scalar(), F.col("last_loaded_id")).alias("last_loaded_id"),
        F.when(top.select("_k").scalar().isNotNull(), F.current_timestamp()).otherwise(F.col("updated_at")).alias("updated_at"))


def log_rows(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Refresh log rows for freshly written tables."""
    return row_counts(tables).select("table_name", F.current_timestamp().alias("refresh_timestamp"), "row_count")


def append_log(rows: DataFrame, path: str, refresh_id: str | None = None) -> None:
    """Add log rows under ``refresh_id``; a run that is repeated under the same id replaces its rows."""
    rows.write.mode("overwrite").parquet(f"{path}/refresh_id={refresh_id or uuid.uuid4().hex}")


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.REFRESH_LOG).parquet(path)


def load_summary(spark: SparkSession, watermark: DataFrame, log: DataFrame, log_name: str) -> DataFrame:
    """One row: status, latest loaded date and rows of the latest run."""
    latest = log.where(F.col("table_name") == log_name).agg(
        F.max_by("row_count", "refresh_timestamp").alias("n"))
    return spark.range(1).select(
        F.lit("Incremental Load Complete").alias("status"),
        watermark.agg(F.max("last_loaded_date").alias("d")).scalar().alias("latest_date"),
        latest.scalar().alias("rows_loaded"))


@dataclass
class LoadPaths:
    """Where a load keeps its table and control data."""

    table: str
    watermark: str
    log: str
    name: str = "sales_transactions"
    key: str = "transaction_id"
    partition_col: str = "sale_month"
    update_columns: Sequence[str] = field(default_factory=lambda: list(UPDATED_ON_CONFLICT))

    @property
    def log_name(self) -> str:
        return f"{self.name}_incremental"


def apply_batch(spark: SparkSession, rows: DataFrame, paths: LoadPaths, stores: DataFrame | None = None,
                products: DataFrame | None = None, required: Sequence[str] = REQUIRED,
                refresh_id: str | None = None) -> dict:
    """Stage one batch, check it, merge it and log it under ``refresh_id``; returns what ``stage`` saw."""
    staged, seen = stage(rows, required, paths.key)
    staging_checks(staged, stores, products, required, paths.key, seen=seen)
    if seen["rows"]:
        merge_into(spark, paths.table, staged, paths.key, paths.update_columns, paths.partition_col)
    log = spark.range(1).select(F.lit(paths.log_name).alias("table_name"),
                                F.current_timestamp().alias("refresh_timestamp"), F.lit(seen["rows"]).cast("long").alias("row_count"))
    append_log(log, paths.log, refresh_id)
    return seen


def next_watermark(watermark: DataFrame, seen: dict) -> DataFrame:
    """The watermark after a load; one without rows keeps the old values."""
    def moved(value, column: str) -> Column:
        return F.coalesce(F.lit(value).cast(watermark.schema[column].dataType), F.col(column))

    return watermark.select(
        "table_name", moved(seen["last_date"], "last_loaded_date").alias("last_loaded_date"), moved(seen["last_key"], "last_loaded_id").alias("last_loaded_id"),
        (F.col("updated_at") if seen["last_key"] is None else F.current_timestamp()).alias("updated_at"))


def run_incremental(spark: SparkSession, source: DataFrame, paths: LoadPaths, stores: DataFrame | None = None,
                    products: DataFrame | None = None, required: Sequence[str] = REQUIRED) -> DataFrame:
    """Load the rows above the stored watermark and return the load summary."""
    watermark = read_watermark(spark, paths.watermark, paths.name)
    seen = apply_batch(spark, incremental_filter(source, watermark, paths.key), paths, stores, products, required)
    next_watermark(watermark, seen).write.mode("append").parquet(paths.watermark)
    return load_summary(spark, read_watermark(spark, paths.watermark, paths.name),
                        read_log(spark, paths.log), paths.log_name)
