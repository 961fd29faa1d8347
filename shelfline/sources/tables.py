"""Reading and writing the retail tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline import schemas
from shelfline.operators.ordered import smallest_rows

DATE_COLUMNS = ["date", "start_date", "end_date", "first_purchase_date", "registration_date"]


class MissingTable(FileNotFoundError):
    """A dataset named by the caller does not exist."""


def _schema(ddl: str | T.StructType) -> T.StructType:
    return ddl if isinstance(ddl, T.StructType) else T.StructType.fromDDL(ddl)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def load_table(spark: SparkSession, directory: str, name: str, fmt: str = "parquet",
               schema: str | T.StructType | None = None) -> DataFrame:
    """One dataset by name with its declared schema; malformed CSV rows fail the read."""
    path = f"{directory}/{name}.{fmt}"
    if not path_exists(spark, path):
        raise MissingTable(f"{name}: no file at {path}")
    schema = schema if schema is not None else schemas.TABLES.get(name)
    if fmt == "csv":
        declared = _schema(schema)
        # Dates arrive as text, so the fixed pattern is applied in one place.
        text = T.StructType([T.StructField(f.name, T.StringType()) if f.name in DATE_COLUMNS else f
                             for f in declared])
        reader = spark.read.schema(text).option("header", True).option("mode", "FAILFAST")
        return parse_dates(reader.option("enforceSchema", False).csv(path))
    reader = spark.read.schema(_schema(schema)) if schema is not None else spark.read
    return reader.parquet(path)


def parse_dates(df: DataFrame, columns: Sequence[str] = DATE_COLUMNS) -> DataFrame:
    """Text to date in whichever date columns exist."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: F.to_date(F.col(c).cast("string"), "yyyy-MM-dd") for c in present})


def load_all(spark: SparkSession, directory: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    """All dimension tables by name."""
    return {name: load_table(spark, directory, name, fmt) for name in schemas.DIMENSIONS}


def load_sales_limited(spark: SparkSession, directory: str, n: int,
                       order_by: Sequence[str] = ("transaction_id",), fmt: str = "parquet") -> DataFrame:
    """The first ``n`` rows of the fact under an explicit order, so that repeated loads agree."""
    return smallest_rows(load_table(spark, directory, "sales_transactions", fmt), n, order_by)


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = (),
                sort_by: Sequence[str] = ()) -> None:
    """Write parquet, optionally one folder per value of ``partition_by``.

    The rebalance hint lets AQE gather the rows of a folder into files of the advisory size: small
    folders get one file, a hot one is split over many tasks.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def bulk_copy(spark: SparkSession, source: str, target: str, fmt: str = "csv",
              tables: Sequence[str] | None = None) -> None:
    """Typed load of the CSV datasets into parquet: dimensions first, then the fact by month."""
    for name in tables or [*schemas.DIMENSIONS, "sales_transactions"]:
        df = load_table(spark, source, name, fmt)
        if name == "sales_transactions":
            df = df.withColumn("sale_month", F.trunc("date", "MM"))
            write_table(df, f"{target}/{name}.parquet", partition_by=["sale_month"], sort_by=["store_id", "date"])
        else:
            write_table(df, f"{target}/{name}.parquet")


def create_table_as(df: DataFrame, path: str) -> DataFrame:
    """Replace a stored summary table and return it."""
    write_table(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_features(df: DataFrame, path: str) -> None:
    """Store the feature table partitioned by month of the feature date."""
    out = df.withColumn("feature_month", F.trunc("date", "MM"))
    write_table(out, path, partition_by=["feature_month"], sort_by=["store_id", "product_id"])


def parameterized_query(spark: SparkSession, text: str, args: dict | None = None,
                        first: bool = False, **frames: DataFrame) -> DataFrame:
    """Run SQL text with named parameters over the given frames; ``first`` keeps one row.

    Frames are referenced in the text as ``{name}``; values as ``:name``.
    """
    out = spark.sql(text, args=args or {}, **frames)
    return out.limit(1) if first else out
