"""Summary tables for dashboards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from shelfline.functions.exprs import (change_pct, frequency_segment, mean, month_of, ratio,
                                       value_segment, week_of)
from shelfline.operators.aggregates import with_distinct_counts
from shelfline.operators.ordered import exact_percentiles
from shelfline.plans.reports import known
from shelfline.session import materialize


def summary_daily_sales(sales: DataFrame, stores: DataFrame, products: DataFrame) -> DataFrame:
    """Day, store and product totals with the dimension attributes.

    The fact is aggregated before the joins, so the dimensions meet the smaller frame and a hot store
    has already been combined on the map side.
    """
    discount = F.when(F.col("discount_applied"), F.col("discount_percent")).otherwise(0)
    daily = with_distinct_counts(
        sales, {k: F.col(k) for k in ("date", "store_id", "product_id")},
        {"total_quantity": F.col("quantity"), "total_revenue": F.col("total_amount"),
         "discounted_transactions": F.when(F.col("discount_applied"), 1).otherwise(0), "discount": discount,
         "n_amounts": known("total_amount"), "n_quantities": known("quantity"), "n_discounts": discount.isNotNull().cast("long")},
        {"transaction_count": "transaction_id", "unique_customers": "customer_id"})
    daily = daily.select("date", "store_id", "product_id", "total_quantity", "total_revenue", "transaction_count", "unique_customers",
                         ratio("total_revenue", "n_amounts").alias("avg_transaction_value"),
                         ratio("total_quantity", "n_quantities").alias("avg_basket_size"), "discounted_transactions",
                         ratio("discount", "n_discounts").alias("avg_discount_pct"))
    return (daily
            .join(stores.select("store_id", "region", "store_format"), "store_id")
            .join(products.select("product_id", "category", "subcategory"), "product_id")
            .select("date", "store_id", "product_id", "region", "store_format", "category", "subcategory",
                    *[c for c in daily.columns if c not in ("date", "store_id", "product_id")]))


def summary_weekly_performance(sales: DataFrame, stores: DataFrame) -> DataFrame:
    """ISO week and store totals; a week that spans new year gives one row per calendar year."""
    weekly = with_distinct_counts(
        sales, {"week_start": week_of("date"), "year": F.year("date"), "week_num": F.weekofyear("date"), "store_id": F.col("store_id")},
        {"weekly_revenue": F.col("total_amount"), "weekly_units": F.col("quantity"), "n_amounts": known("total_amount")},
        {"weekly_transactions": "transaction_id", "weekly_customers": "customer_id"})
    weekly = weekly.withColumn("avg_transaction_value", ratio("weekly_revenue", "n_amounts"))
    return (weekly.join(stores.select("store_id", "store_name", "region", "size_sqft"), "store_id")
            .select("week_start", "year", "week_num", "store_id", "store_name", "region", "weekly_revenue",
                    "weekly_units", "weekly_transactions", "weekly_customers", "avg_transaction_value",
                    ratio("weekly_revenue", "size_sqft").alias("revenue_per_sqft")))


def monthly_totals(sales: DataFrame) -> DataFrame:
    return with_distinct_counts(
        sales, {"month": month_of("date")}, {"revenue": F.col("total_amount"), "units": F.col("quantity")},
        {"transactions": "transaction_id", "customers": "customer_id"})


def summary_monthly_kpis(sales: DataFrame) -> DataFrame:
    """Monthly totals with month and year changes and the year-to-date sum.

    The un-partitioned window runs over one row per calendar month only.
    """
    by_month = W.orderBy("month")
    this_year = W.partitionBy(F.year("month")).orderBy("month")
    return (monthly_totals(sales)
            .withColumn("prev_month_revenue", F.lag("revenue", 1).over(by_month))
            .withColumn("prev_year_revenue", F.lag("revenue", 12).over(by_month))
            .select("month", "revenue", "units", "transactions", "customers", "prev_month_revenue",
                    change_pct("revenue", "prev_month_revenue").alias("mom_growth_pct"),
                    "prev_year_revenue",
                    change_pct("revenue", "prev_year_revenue").alias("yoy_growth_pct"),
                    F.sum("revenue").over(this_year).alias("ytd_revenue"))
            .orderBy("month"))


def customer_metrics(sales: DataFrame) -> DataFrame:
    """First and last purchase, orders and revenue per known customer."""
    return sales.where(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        F.min("date").alias("first_purchase"),
        F.max("date").alias("last_purchase"),
        F.count_distinct("transaction_id").alias("total_orders"),
        F.sum("total_amount").alias("lifetime_revenue"),
        mean("total_amount").alias("avg_order_value"))


def summary_customer_segments(sales: DataFrame, high: float = 0.8, mid: float = 0.5) -> DataFrame:
    """Value and frequency segment per customer.

    The customer aggregate is stored once and read for both the percentiles and the result.
    """
    metrics = materialize(customer_metrics(sales), "customer-metrics")
    cut = exact_percentiles(metrics, "lifetime_revenue", [high, mid], ["high", "mid"])
    revenue = F.col("lifetime_revenue").cast("double")
    return metrics.select(
        "customer_id", "first_purchase", "last_purchase", "total_orders", "lifetime_revenue",
        F.round("avg_order_value", 2).alias("avg_order_value"),
        F.datediff("last_purchase", "first_purchase").alias("customer_tenure_days"),
        value_segment(revenue, cut.select("high").scalar(), cut.select("mid").scalar()).alias("value_segment"),
        frequency_segment("total_orders").alias("frequency_segment"))
