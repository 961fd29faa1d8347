"""The incremental load and the daily totals as Structured Streaming jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from shelfline.operators.aggregates import daily_sales_agg
from shelfline.plans.incremental import REQUIRED, LoadPaths, apply_batch


def file_stream(spark: SparkSession, directory: str, schema, files_per_batch: int = 1000) -> DataFrame:
    """Parquet files that arrive in a folder, in bounded batches."""
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(directory))


def stream_incremental_load(spark: SparkSession, source: DataFrame, paths: LoadPaths, checkpoint: str,
                            stores: DataFrame | None = None, products: DataFrame | None = None,
                            required: Sequence[str] = REQUIRED, delivered: str = "loaded_at") -> StreamingQuery:
    """Check, upsert and log every micro-batch of ``source``, whatever the dates of its rows.

    The stream's checkpoint takes the place of the watermark table. A batch may hold several deliveries; of a key
    the rows of its latest delivery (by the column ``delivered``) count. Two different rows of a key in one
    delivery fail the check. A batch that is replayed after a failure merges to the same table and replaces its
    own log row. No state is kept between batches.
    """
    def load(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            last = batch.groupBy(paths.key).agg(F.max(delivered).alias("_last")).withColumnRenamed(paths.key, "_key")
            newest = batch.join(last, batch[paths.key].eqNullSafe(last["_key"]) & batch[delivered].eqNullSafe(last["_last"]), "left_semi")
            apply_batch(batch.sparkSession, newest.drop(delivered).distinct(), paths, stores, products, required, str(batch_id))

    return (source.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def stream_daily_sales(source: DataFrame, target: str, checkpoint: str, event_time: str = "event_time") -> StreamingQuery:
    """Daily totals per store and product of a stream, to be read with ``read_daily``.

    Totals add up, so every micro-batch writes the totals of its own rows to a folder of its own: no state is kept, no
    row is too late, and a batch that is replayed after a failure replaces its folder.
    """
    def add(batch: DataFrame, batch_id: int) -> None:
        totals = daily_sales_agg(batch.withColumn("date", F.to_date(event_time)))
        totals.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    return (source.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def read_daily(spark: SparkSession, target: str) -> DataFrame:
    """The daily totals over all batches so far."""
    parts = spark.read.parquet(target)
    return parts.groupBy("date", "store_id", "product_id").agg(
        *[F.sum(c).alias(c) for c in ("daily_quantity", "daily_revenue", "transaction_count", "discounted_count")])
