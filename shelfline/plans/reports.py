"""The five analytical reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from shelfline.functions.exprs import (abc_class, avg_temperature, growth_pct, mean, month_of,
                                       months_between_starts, precipitation_level, ratio, ratio_pct,
                                       temperature_band)
from shelfline.operators.aggregates import with_distinct_counts
from shelfline.operators.ordered import add_ntile, add_percent_rank, add_rank, add_running_total
from shelfline.session import materialize


def known(column: str) -> Column:
    """1 where the column has a value, for counting by addition."""
    return F.col(column).isNotNull().cast("long")


def report_monthly_trends(sales: DataFrame) -> DataFrame:
    """Monthly revenue with rolling mean, month-over-month and year-over-year growth.

    Comparisons are by row: a month without sales shifts them. The window sees one row per month.
    """
    monthly = with_distinct_counts(
        sales, {"sale_month": month_of("date")},
        {"total_revenue": F.col("total_amount"), "total_units_sold": F.col("quantity"), "n_amounts": known("total_amount")},
        {"transaction_count": "transaction_id", "unique_customers": "customer_id"})
    monthly = monthly.withColumn("avg_transaction_value", ratio("total_revenue", "n_amounts"))
    by_month = W.orderBy("sale_month")
    last3 = by_month.rowsBetween(-2, W.currentRow)
    prev, year_ago = F.lag("total_revenue", 1).over(by_month), F.lag("total_revenue", 12).over(by_month)
    return monthly.select(
        "sale_month", F.year("sale_month").alias("sale_year"), F.month("sale_month").alias("sale_month_num"),
        "total_revenue", "total_units_sold", "transaction_count", "unique_customers",
        F.round("avg_transaction_value", 2).alias("avg_transaction_value"),
        ratio(F.sum("total_revenue").over(last3), F.count("total_revenue").over(last3)).alias("rolling_3m_avg_revenue"),
        growth_pct("total_revenue", prev).alias("mom_growth_pct"),
        growth_pct("total_revenue", year_ago).alias("yoy_growth_pct"),
    ).orderBy("sale_month")


def store_metrics(stores: DataFrame, sales: DataFrame) -> DataFrame:
    """Sales totals per store; stores without sales stay with NULL totals and zero counts."""
    totals = with_distinct_counts(
        sales, {"store_id": F.col("store_id")}, {"total_revenue": F.col("total_amount"), "total_units_sold": F.col("quantity")},
        {"transaction_count": "transaction_id", "unique_customers": "customer_id", "active_days": "date"})
    counts = ["transaction_count", "unique_customers", "active_days"]
    return (stores.select("store_id", "store_name", "region", "store_format", "size_sqft", "open_date")
            .join(totals, "store_id", "left").fillna(0, counts))


def regional_benchmarks(metrics: DataFrame) -> DataFrame:
    """Mean revenue and mean revenue per square foot of the stores of each region."""
    return metrics.groupBy("region").agg(
        mean("total_revenue").alias("avg_regional_revenue"),
        # Rounded terms are exact decimals: the mean does not depend on the order of addition.
        mean(ratio("total_revenue", "size_sqft").cast("decimal(24,8)")).alias("regional_rev_per_sqft"))


def report_store_ranking(stores: DataFrame, sales: DataFrame) -> DataFrame:
    """Store ranking over all stores, in region and in format, against the regional mean.

    Ranks come from block-wise order statistics over the stored store aggregate, so no task sees all stores.
    """
    metrics = materialize(store_metrics(stores, sales), "stores")
    ranked = add_rank(metrics, "total_revenue", "overall_rank", of=metrics)
    ranked = add_rank(ranked, "total_revenue", "regional_rank", by=["region"], of=metrics)
    ranked = add_rank(ranked, "total_revenue", "format_rank", by=["store_format"], of=metrics)
    ranked = add_ntile(ranked, "total_revenue", "store_id", 4, "performance_quartile", of=metrics)
    ranked = add_percent_rank(ranked, "total_revenue", "percentile", of=metrics)
    # Stored first, so that the planner knows its size: a few rows are broadcast, many are not.
    ranked = ranked.join(materialize(regional_benchmarks(metrics), "regions"), "region")
    revenue_per_sqft = F.round(ratio("total_revenue", "size_sqft"), 2)
    return ranked.select(
        "store_id", "store_name", "region", "store_format", "size_sqft", "open_date",
        "total_revenue", "total_units_sold", "transaction_count", "unique_customers",
        revenue_per_sqft.alias("revenue_per_sqft"),
        F.round(ratio("total_revenue", "active_days"), 2).alias("avg_daily_revenue"),
        "overall_rank", "regional_rank", "format_rank", "performance_quartile",
        F.round(F.col("percentile") * 100, 1).alias("percentile_rank"),
        ratio_pct(F.col("total_revenue").cast("double") - F.col("avg_regional_revenue"),
                  "avg_regional_revenue").alias("pct_vs_regional_avg"),
        ratio_pct(revenue_per_sqft, "regional_rev_per_sqft", 1).alias("efficiency_index"),
    ).orderBy("overall_rank", "store_id")


def category_sales(products: DataFrame, sales: DataFrame) -> DataFrame:
    """Totals per category and subcategory.

    The fact is reduced to products, and to (product, transaction) pairs for the distinct count, before it meets
    the dimension.
    """
    per_product = sales.groupBy("product_id").agg(
        F.sum("total_amount").alias("revenue"), F.sum("quantity").alias("units"), F.count("total_amount").alias("n_amounts"),
        F.count(F.lit(1)).alias("n_rows"))
    priced = per_product.join(products.select("product_id", "category", "subcategory", F.col("unit_price").alias("list_price")), "product_id")
    keys = ["category", "subcategory"]
    rows_priced = F.when(F.col("list_price").isNotNull(), F.col("n_rows"))
    totals = priced.groupBy(*keys).agg(
        F.sum("revenue").alias("category_revenue"), F.sum("units").alias("category_units"), F.count("product_id").alias("product_count"),
        ratio(F.sum("revenue"), F.sum("n_amounts")).alias("avg_transaction_value"),
        ratio(F.sum(F.col("list_price") * rows_priced.cast("decimal(18,0)")), F.sum(rows_priced)).alias("avg_unit_price"))
    pairs = sales.select("product_id", "transaction_id").distinct()
    baskets = pairs.join(products.select("product_id", *keys), "product_id").groupBy(*keys).agg(
        F.count_distinct("transaction_id").alias("category_transactions"))
    baskets = baskets.withColumnsRenamed({k: f"_{k}" for k in keys})
    same = F.col("category").eqNullSafe(F.col("_category")) & F.col("subcategory").eqNullSafe(F.col("_subcategory"))
    return totals.join(baskets, same).drop("_category", "_subcategory")


def report_category_abc(products: DataFrame, sales: DataFrame) -> DataFrame:
    """Contribution, Pareto running share, rank and ABC class per category and subcategory."""
    stored = materialize(category_sales(products, sales), "categories")
    cats = add_rank(stored, "category_revenue", "category_rank", of=stored)
    cats = add_running_total(cats, "category_revenue", "cumulative_revenue", "grand_revenue", of=stored)
    cats = cats.withColumn("grand_units", stored.agg(F.sum("category_units").alias("u")).scalar())
    cats = cats.withColumn("cumulative_pct", ratio_pct("cumulative_revenue", "grand_revenue"))
    return cats.select(
        "category", "subcategory", "category_revenue", "category_units", "category_transactions",
        "product_count",
        F.round("avg_transaction_value", 2).alias("avg_transaction_value"),
        F.round("avg_unit_price", 2).alias("avg_unit_price"),
        F.round(ratio("category_revenue", "category_units"), 2).alias("revenue_per_unit"),
        F.round(ratio("category_units", "category_transactions"), 2).alias("avg_basket_size"),
        ratio_pct("category_revenue", "grand_revenue").alias("revenue_contribution_pct"),
        ratio_pct("category_units", "grand_units").alias("units_contribution_pct"),
        "cumulative_revenue", "cumulative_pct", "category_rank",
        abc_class("cumulative_pct").alias("abc_classification"),
    ).orderBy("category_rank", "category", "subcategory")


def daily_store_sales(sales: DataFrame) -> DataFrame:
    return with_distinct_counts(
        sales, {"date": F.col("date"), "store_id": F.col("store_id")},
        {"daily_revenue": F.col("total_amount"), "daily_units": F.col("quantity")},
        {"daily_transactions": "transaction_id", "daily_customers": "customer_id"})


def weather_sales(sales: DataFrame, weather: DataFrame) -> DataFrame:
    """Daily store totals with that day's weather."""
    return (daily_store_sales(sales)
            .join(weather.select("date", "store_id", "temp_high_f", "temp_low_f", "precipitation_inches",
                                 "conditions"), ["date", "store_id"])
            .withColumn("avg_temp_f", avg_temperature("temp_high_f", "temp_low_f")))


def report_weather_impact(sales: DataFrame, weather: DataFrame) -> DataFrame:
    """Mean daily sales by condition, temperature band and rain level, stacked.

    Grouping sets give the three analyses in one pass over the joined frame.
    """
    days = weather_sales(sales, weather).select(
        "conditions", temperature_band("avg_temp_f").alias("band"),
        precipitation_level("precipitation_inches").alias("rain"),
        "daily_revenue", "daily_units", "daily_transactions", "daily_customers")
    sets = [[F.col("conditions")], [F.col("band")], [F.col("rain")]]
    which = F.grouping_id()  # bit set = column rolled up: 3 condition, 5 band, 6 rain
    out = days.groupingSets(sets, "conditions", "band", "rain").agg(
        which.alias("which"),
        F.count(F.lit(1)).alias("observation_count"),
        *[F.round(mean(c), 2).alias(f"avg_{c}")
          for c in ("daily_revenue", "daily_units", "daily_transactions", "daily_customers")],
        F.round(F.stddev_samp(F.col("daily_revenue").cast("double")), 2).alias("revenue_std_dev"))
    condition, band = F.col("which") == 3, F.col("which") == 5
    rain = F.col("which") == 6
    return out.select(
        F.when(condition, "By Condition").when(band, "By Temperature").otherwise("By Precipitation").alias("analysis_type"),
        F.when(condition, F.col("conditions")).when(band, F.col("band")).otherwise(F.col("rain")).alias("category"),
        "observation_count", "avg_daily_revenue",
        F.when(~rain, F.col("avg_daily_units")).alias("avg_daily_units"),
        "avg_daily_transactions",
        F.when(~band, F.col("avg_daily_customers")).alias("avg_daily_customers"),
        F.when(condition, F.col("revenue_std_dev")).alias("revenue_std_dev"),
    ).orderBy("analysis_type", F.col("avg_daily_revenue").desc_nulls_last())


def customer_months(sales: DataFrame) -> DataFrame:
    """Spend and orders per known customer and month, with the customer's first month.

    The window runs on the aggregate: a customer has at most one row per calendar month.
    """
    active = sales.where(F.col("customer_id").isNotNull()).groupBy(
        "customer_id", month_of("date").alias("activity_month"),
    ).agg(F.sum("total_amount").alias("monthly_spend"),
          F.count_distinct("transaction_id").alias("monthly_transactions"))
    return active.withColumn("cohort_month", F.min("activity_month").over(W.partitionBy("customer_id")))


def report_cohort_retention(sales: DataFrame, max_period: int = 12) -> DataFrame:
    """Retention, revenue and lifetime value per first-purchase month and months since.

    Every customer is active in period 0 exactly once, so the cohort size is the active count of
    period 0: the fact is read once and nothing is joined.
    """
    period = months_between_starts("activity_month", "cohort_month")
    matrix = customer_months(sales).groupBy("cohort_month", period.alias("cohort_period")).agg(
        F.count(F.lit(1)).alias("active_customers"),
        F.sum("monthly_spend").alias("cohort_revenue"),
        F.sum("monthly_transactions").alias("cohort_transactions")).where(F.col("cohort_period") <= max_period)
    cohort = W.partitionBy("cohort_month")
    by_period = cohort.orderBy("cohort_period")
    size = F.max(F.when(F.col("cohort_period") == 0, F.col("active_customers"))).over(cohort)
    matrix = matrix.withColumn("original_cohort_size", size).withColumn(
        "retention_rate_pct", ratio_pct("active_customers", "original_cohort_size"))
    return matrix.select(
        "cohort_month", "cohort_period", "original_cohort_size", "active_customers", "retention_rate_pct",
        "cohort_revenue", "cohort_transactions",
        F.round(ratio("cohort_revenue", "active_customers"), 2).alias("avg_spend_per_customer"),
        ratio(F.sum("cohort_revenue").over(by_period), "original_cohort_size").alias("cumulative_rev_per_customer"),
        F.round(F.col("retention_rate_pct") - F.lag("retention_rate_pct", 1).over(by_period), 2)
        .alias("retention_change_ppt"),
    ).orderBy("cohort_month", "cohort_period")
