"""Promotions: day expansion, activity test and pricing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Promotions of any length are matched by blocks of days, so their row count stays small.
BLOCK_DAYS = 32
DAY_KEYS = ["date", "store_id", "product_id"]


def promo_expand_days(promotions: DataFrame) -> DataFrame:
    """One row per promotion and day. A promotion that ends before it starts has no day."""
    days = F.explode(F.sequence("start_date", "end_date"))
    return (promotions.where("start_date <= end_date")
            .select("store_id", "product_id", "discount_percent", days.alias("date")))


def promo_days(promotions: DataFrame) -> DataFrame:
    """Largest discount per day, store and product over overlapping promotions."""
    return promo_expand_days(promotions).groupBy("date", "store_id", "product_id").agg(
        F.max("discount_percent").alias("promotion_discount")).withColumn("has_promotion", F.lit(True))


def _block(date: str):
    return F.floor(F.datediff(date, F.lit("1970-01-01")) / BLOCK_DAYS)


def with_active_discount(sales: DataFrame, promotions: DataFrame) -> DataFrame:
    """Sales with ``promotion_discount``: the largest discount active that day, NULL without one.

    Promotions are spread over the blocks of days they touch. The distinct days of each store and product on sale
    meet the promotions of their block, and the result, one row per day and series, joins the sales.
    """
    blocks = F.explode(F.sequence(_block("start_date"), _block("end_date"))).alias("_block")
    pieces = promotions.where("start_date <= end_date").select("store_id", "product_id", "discount_percent", "start_date", "end_date", blocks)
    days = sales.select(*DAY_KEYS).distinct().withColumn("_block", _block("date"))
    hits = (days.join(pieces, ["store_id", "product_id", "_block"])
            .where(F.col("date").between(F.col("start_date"), F.col("end_date")))
            .groupBy(*DAY_KEYS).agg(F.max("discount_percent").alias("promotion_discount")))
    return sales.join(hits, DAY_KEYS, "left")


def promo_range_join(sales: DataFrame, promotions: DataFrame) -> DataFrame:
    """Sales with ``in_promotion``: whether a promotion of that store and product is active that day."""
    return (with_active_discount(sales, promotions)
            .withColumn("in_promotion", F.col("promotion_discount").isNotNull()).drop("promotion_discount"))


def promo_effective_price(sales: DataFrame, promotions: DataFrame, base_price: str = "base_price") -> DataFrame:
    """Price each sale by its active promotion; of overlapping promotions the largest discount counts."""
    pct = F.coalesce(F.col("promotion_discount"), F.lit(0))
    share = (F.lit(100) - pct).cast("decimal(3,0)") * F.lit("0.01").cast("decimal(3,2)")
    price = F.round(F.col(base_price).cast("decimal(12,2)") * share, 2)
    return (with_active_discount(sales, promotions)
            .withColumn("unit_price", price)
            .withColumn("total_amount", F.round(F.col("unit_price") * F.col("quantity"), 2))
            .withColumn("discount_applied", pct > 0)
            .withColumn("discount_percent", pct)
            .drop("promotion_discount"))
