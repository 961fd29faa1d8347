"""Exploratory analyses. Facts are aggregated to days, stores or products before they meet dimensions."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from shelfline.functions.exprs import (avg_temperature, equal_width_bin, growth_pct, mean, month_of,
                                       precipitation_level, ratio, ratio_pct, temperature_band, DRY)
from shelfline.operators.ordered import exact_percentiles
from shelfline.session import materialize

CORRELATED = ["total_amount", "quantity", "temp_high_f", "temp_low_f", "precipitation_inches", "humidity_percent",
              "day_of_week", "is_weekend", "is_holiday", "week_of_year", "month"]
TARGET = "total_amount"


def eda_daily_trend(sales: DataFrame) -> DataFrame:
    """Revenue, units and transactions per day with the calendar parts used for grouping."""
    return sales.groupBy("date").agg(
        F.sum("total_amount").alias("revenue"), F.sum("quantity").alias("units"),
        F.count("transaction_id").alias("num_transactions"),
    ).withColumns({"year": F.year("date"), "month": F.month("date"), "day_of_week": F.weekday("date")})


def eda_daily_summary(sales: DataFrame) -> DataFrame:
    return eda_daily_trend(sales).agg(
        F.sum("revenue").alias("total_revenue"), mean("revenue").alias("avg_daily_revenue"),
        F.max("revenue").alias("max_daily_revenue"), F.min("revenue").alias("min_daily_revenue"))


def eda_monthly_resample(sales: DataFrame) -> DataFrame:
    """Month totals; months without sales inside the range appear with zeros."""
    months = sales.groupBy(month_of("date").alias("month_start")).agg(
        F.sum("total_amount").alias("revenue"), F.sum("quantity").alias("units"),
        F.count("transaction_id").alias("num_transactions"))
    spine = months.agg(F.min("month_start").alias("a"), F.max("month_start").alias("b")).where("a IS NOT NULL").select(
        F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 MONTH"))).alias("month_start"))
    return spine.join(months, "month_start", "left").fillna(0)


def eda_month_pattern(sales: DataFrame) -> DataFrame:
    """Mean daily revenue per month of the year; months never seen have 0."""
    by_month = eda_daily_trend(sales).groupBy("month").agg(mean("revenue").alias("avg_daily_revenue"))
    spine = sales.sparkSession.range(1, 13).select(F.col("id").cast("int").alias("month"))
    return spine.join(by_month, "month", "left").fillna(0.0)


def eda_dow_pattern(sales: DataFrame) -> DataFrame:
    return eda_daily_trend(sales).groupBy("day_of_week").agg(mean("revenue").alias("avg_daily_revenue"))


def eda_dow_summary(sales: DataFrame) -> DataFrame:
    """Weekend to weekday ratio of the day means, best and worst day."""
    days = eda_dow_pattern(sales).withColumn("r", F.round("avg_daily_revenue", 6).cast("decimal(30,6)"))
    end = F.col("day_of_week") >= 5
    return days.agg(
        ratio(mean(F.when(end, F.col("r"))), mean(F.when(~end, F.col("r")))).alias("weekend_ratio"),
        F.max_by("day_of_week", "r").alias("best_day"), F.min_by("day_of_week", "r").alias("worst_day"))


def with_lift(groups: DataFrame, flag: str, measure: str, out: str) -> DataFrame:
    """Adds the lift of the true group over the false one, in percent.

    The window sees the two or three rows of the flag's groups; the fact is aggregated once.
    """
    whole = W.partitionBy()
    yes = F.max(F.when(F.col(flag), F.col(measure))).over(whole)
    no = F.max(F.when(~F.col(flag), F.col(measure))).over(whole)
    return groups.withColumn(out, F.round((ratio(yes, no) - 1) * 100, 4))


def eda_holiday_lift(sales: DataFrame, calendar: DataFrame) -> DataFrame:
    """Mean, sum and count of sales on holidays and regular days, with the lift."""
    days = sales.groupBy("date").agg(F.sum("total_amount").alias("s"), F.count("total_amount").alias("n"))
    groups = days.join(calendar.select("date", "is_holiday"), "date", "left").groupBy("is_holiday").agg(
        ratio(F.sum("s"), F.sum("n")).alias("avg_transaction"), F.sum("s").alias("total_sales"),
        F.sum("n").alias("num_transactions"))
    return with_lift(groups, "is_holiday", "avg_transaction", "holiday_lift_pct")


def store_totals(sales: DataFrame, stores: DataFrame) -> DataFrame:
    totals = sales.groupBy("store_id").agg(
        F.sum("total_amount").alias("revenue"), F.sum("quantity").alias("units"),
        F.count("transaction_id").alias("num_transactions"))
    return totals.join(stores.select("store_id", "store_name", "region", "store_format", "size_sqft"), "store_id")


def eda_store_perf(sales: DataFrame, stores: DataFrame) -> DataFrame:
    """Totals by region and by format, stacked, in one pass over the store totals."""
    sets = [[F.col("region")], [F.col("store_format")]]
    out = store_totals(sales, stores).groupingSets(sets, "region", "store_format").agg(
        F.grouping("region").alias("no_region"), F.count(F.lit(1)).alias("stores"), F.sum("revenue").alias("revenue"),
        F.sum("units").alias("units"), F.sum("num_transactions").alias("num_transactions"))
    by_region = F.col("no_region") == 0
    return out.select(F.when(by_region, "region").otherwise("store_format").alias("level"),
                      F.when(by_region, F.col("region")).otherwise(F.col("store_format")).alias("name"),
                      "stores", "revenue", "units", "num_transactions")


def eda_store_size_trend(sales: DataFrame, stores: DataFrame) -> DataFrame:
    """Correlation of size and revenue, and the least-squares line."""
    x, y = F.col("size_sqft").cast("double"), F.col("revenue").cast("double")
    return store_totals(sales, stores).agg(
        F.round(F.corr(x, y), 6).alias("size_sales_corr"), F.round(F.regr_slope(y, x), 6).alias("slope"),
        F.round(F.regr_intercept(y, x), 2).alias("intercept"))


def product_totals(sales: DataFrame, products: DataFrame) -> DataFrame:
    totals = sales.groupBy("product_id").agg(F.sum("total_amount").alias("revenue"), F.sum("quantity").alias("units"))
    return totals.join(products.select("product_id", "category", "is_perishable"), "product_id")


def eda_category(sales: DataFrame, products: DataFrame) -> DataFrame:
    return product_totals(sales, products).groupBy("category").agg(
        F.sum("revenue").alias("revenue"), F.sum("units").alias("units"), F.count(F.lit(1)).alias("products"))


def eda_perishable_split(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue of perishable and other products with its share; the window sees those two rows."""
    split = product_totals(sales, products).groupBy("is_perishable").agg(F.sum("revenue").alias("revenue"))
    return split.withColumn("share_pct", ratio_pct("revenue", F.sum("revenue").over(W.partitionBy())))


def histogram(df: DataFrame, value: str, bins: int = 50) -> DataFrame:
    """Equal-width histogram between minimum and maximum; bins without rows are absent."""
    span = df.agg(F.min(value).cast("double").alias("lo"), F.max(value).cast("double").alias("hi"))
    lo, hi = span.select("lo").scalar(), span.select("hi").scalar()
    binned = df.where(F.col(value).isNotNull()).groupBy(equal_width_bin(value, lo, hi, bins).alias("bin"))
    return binned.agg(F.count(F.lit(1)).alias("row_count"), F.min(value).alias("lowest"), F.max(value).alias("highest"))


def eda_price_histogram(products: DataFrame, bins: int = 50) -> DataFrame:
    return histogram(products.select("unit_price"), "unit_price", bins)


def eda_price_summary(products: DataFrame) -> DataFrame:
    median = exact_percentiles(products.select("unit_price"), "unit_price", [0.5], ["median"])
    return products.agg(mean("unit_price").alias("mean_price")).withColumn("median_price", F.round(median.scalar(), 4))


def eda_weather_impact(sales: DataFrame, weather: DataFrame) -> DataFrame:
    """Mean, sum and count of sales per weather condition; sales without weather form a NULL group."""
    days = sales.groupBy("date", "store_id").agg(F.sum("total_amount").alias("s"), F.count("total_amount").alias("n"))
    return days.join(weather.select("date", "store_id", "conditions"), ["date", "store_id"], "left").groupBy("conditions").agg(
        F.round(ratio(F.sum("s"), F.sum("n")), 2).alias("avg_transaction"), F.sum("s").alias("total_sales"),
        F.sum("n").alias("num_transactions"))


def eda_temperature_corr(sales: DataFrame, weather: DataFrame) -> DataFrame:
    """Correlation of daily high and sale amount over all sales.

    All sales of a store and day share the temperature, so their count, mean and squared deviations are enough and
    the join meets store days instead of sales. Deviations are taken from the overall means: nothing cancels.
    """
    y = F.col("total_amount").cast("double")
    days = sales.where(F.col("total_amount").isNotNull()).groupBy("date", "store_id").agg(
        F.count(F.lit(1)).cast("double").alias("n"), mean("total_amount").alias("y"), F.var_pop(y).alias("v"))
    w = days.join(weather.select("date", "store_id", F.col("temp_high_f").cast("double").alias("x")).where("x is not null"), ["date", "store_id"])
    w = materialize(w.select("n", "x", "y", "v"), "store-days")
    means = w.agg(ratio(F.sum(F.col("n") * F.col("x")), F.sum("n")).alias("x"), ratio(F.sum(F.col("n") * F.col("y")), F.sum("n")).alias("y"))
    n, dx, dy = F.col("n"), F.col("x") - F.col("mx"), F.col("y") - F.col("my")
    s = w.withColumns({"mx": means.select("x").scalar(), "my": means.select("y").scalar()}).agg(
        F.sum(n * dx * dx).alias("xx"), F.sum(n * (F.col("v") + dy * dy)).alias("yy"), F.sum(n * dx * dy).alias("xy"))
    return s.select(F.round(F.try_divide(F.col("xy"), F.sqrt(F.col("xx") * F.col("yy"))), 6).alias("temp_sales_corr"))


def eda_promo_lift(sales: DataFrame) -> DataFrame:
    """Sales with and without discount, with the lift in quantity."""
    groups = sales.groupBy("discount_applied").agg(
        mean("total_amount").alias("avg_amount"), F.sum("total_amount").alias("total_amount"),
        F.count("total_amount").alias("transactions"), mean("quantity").alias("avg_quantity"))
    return with_lift(groups, "discount_applied", "avg_quantity", "quantity_lift_pct")


def eda_segments(customers: DataFrame) -> DataFrame:
    """Customers, share and mean lifetime value per segment; the window sees one row per segment."""
    groups = customers.groupBy("segment").agg(F.count(F.lit(1)).alias("customers"), mean("lifetime_value").alias("avg_lifetime_value"))
    return groups.withColumn("share_pct", ratio_pct("customers", F.sum("customers").over(W.partitionBy()), 1))


def correlation_frame(sales: DataFrame, weather: DataFrame, calendar: DataFrame) -> DataFrame:
    days = sales.groupBy("date", "store_id").agg(F.sum("total_amount").alias("total_amount"), F.sum("quantity").alias("quantity"))
    wet = weather.select("date", "store_id", "temp_high_f", "temp_low_f", "precipitation_inches", "humidity_percent")
    cal = calendar.select("date", "day_of_week", "is_weekend", "is_holiday", "week_of_year", "month")
    return days.join(wet, ["date", "store_id"], "left").join(cal, "date", "left")


def eda_correlation_matrix(frame: DataFrame, columns: Sequence[str] = CORRELATED) -> DataFrame:
    """Upper triangle of the Pearson matrix in long form, all pairs in one aggregation."""
    def num(c: str) -> Column:
        return F.col(c).cast("int").cast("double") if frame.schema[c].dataType.typeName() == "boolean" else F.col(c).cast("double")
    pairs = list(combinations(columns, 2))
    row = frame.agg(*[F.round(F.corr(num(a), num(b)), 6).alias(f"{a}|{b}") for a, b in pairs])
    long = row.unpivot([], row.columns, "pair", "correlation")
    return long.select(F.substring_index("pair", "|", 1).alias("column_a"),
                       F.substring_index("pair", "|", -1).alias("column_b"), "correlation")


def target_correlations(matrix: DataFrame, target: str = TARGET) -> DataFrame:
    """Absolute correlation of every column with the target, strongest first."""
    other = F.when(F.col("column_a") == target, F.col("column_b")).otherwise(F.col("column_a"))
    return (matrix.where((F.col("column_a") == target) | (F.col("column_b") == target))
            .select(other.alias("feature"), F.abs("correlation").alias("abs_correlation"))
            .orderBy(F.col("abs_correlation").desc_nulls_last(), "feature"))


# --- analyses behind the figures quoted in the business report -------------------------------------


def category_pairs(products: DataFrame) -> DataFrame:
    """(category_a, category_b) of all pairs of the dimension's categories, each once in their order."""
    names = products.agg(F.array_sort(F.collect_set("category")).alias("names"))
    each = names.select("names", F.posexplode("names").alias("at", "category_a"))
    rest = F.slice("names", F.col("at") + 2, F.greatest(F.size("names") - F.col("at") - 1, F.lit(0)))
    return each.select("category_a", F.explode(rest).alias("category_b"))


def insight_copurchase(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Correlation between the amounts customers spend in the categories of the dimension, 0 where they buy nothing.

    The fact is reduced to customers and products before it meets the dimension, then to customers and categories.
    Sums of squares and of products come from the categories that a customer does buy in; the zeros only count.
    """
    bought = sales.where(F.col("customer_id").isNotNull()).groupBy("customer_id", "product_id").agg(F.sum("total_amount").alias("s"))
    spend = bought.join(products.select("product_id", "category"), "product_id").groupBy("customer_id", "category").agg(
        F.coalesce(F.sum("s"), F.lit(0)).cast("double").alias("s"))
    spend = materialize(spend, "spend")
    people = spend.agg(F.count_distinct("customer_id").cast("double").alias("n")).scalar()
    x = F.col("s")
    alone = spend.groupBy("category").agg(F.sum(x).alias("x"), F.sum(x * x).alias("xx"))
    a, b = (spend.select("customer_id", F.col("category").alias(f"category_{k}"), x.alias(f"s_{k}")) for k in "ab")
    both = a.join(b, "customer_id").where("category_a < category_b").groupBy("category_a", "category_b").agg(F.sum(F.col("s_a") * F.col("s_b")).alias("xy"))
    found = category_pairs(products).join(both, ["category_a", "category_b"], "left")
    for k in "ab":
        found = found.join(alone.select(F.col("category").alias(f"category_{k}"), F.col("x").alias(f"x_{k}"), F.col("xx").alias(f"xx_{k}")), f"category_{k}", "left")
    part = lambda k: F.greatest(people * F.col(f"xx_{k}") - F.col(f"x_{k}") * F.col(f"x_{k}"), F.lit(0.0))
    shared = people * F.coalesce("xy", F.lit(0.0)) - F.col("x_a") * F.col("x_b")
    spread = F.sqrt(part("a")) * F.sqrt(part("b"))
    return found.select("category_a", "category_b", F.round(F.when(spread > 0, shared / spread), 6).alias("correlation"))


def insight_early_buyers(sales: DataFrame, days: int = 60, least: int = 3) -> DataFrame:
    """Customers with at least ``least`` purchases in their first days against the others.

    Purchases are first counted per customer and day, so the window sees at most one row per day.
    """
    daily = sales.where(F.col("customer_id").isNotNull()).groupBy("customer_id", "date").agg(
        F.count_distinct("transaction_id").alias("n"), F.sum("total_amount").alias("s"))
    first = F.min("date").over(W.partitionBy("customer_id"))
    daily = daily.withColumn("early", F.datediff("date", first) < days)
    people = daily.groupBy("customer_id").agg(
        (F.coalesce(F.sum(F.when(F.col("early"), F.col("n"))), F.lit(0)) >= least).alias("is_early_buyer"), F.sum("s").alias("ltv"))
    groups = people.groupBy("is_early_buyer").agg(F.count(F.lit(1)).alias("customers"), mean("ltv").alias("avg_ltv"))
    return with_lift(groups, "is_early_buyer", "avg_ltv", "ltv_lift_pct")


def insight_lag_autocorr(sales: DataFrame, lags: Sequence[int] = (7, 30)) -> DataFrame:
    """Autocorrelation of daily revenue; the window sees one row per day."""
    x = F.col("revenue").cast("double")
    days = sales.groupBy("date").agg(F.sum("total_amount").alias("revenue"))
    lagged = days.select(x.alias("x"), *[F.lag(x, k).over(W.orderBy("date")).alias(f"lag_{k}") for k in lags])
    row = lagged.agg(*[F.round(F.corr("x", f"lag_{k}"), 6).alias(f"lag_{k}") for k in lags])
    return row.unpivot([], row.columns, "lag", "autocorrelation")


def insight_region_growth(sales: DataFrame, stores: DataFrame) -> DataFrame:
    """Revenue per store, year-over-year growth and spread of store revenue by region and year."""
    yearly = sales.groupBy("store_id", F.year("date").alias("year")).agg(F.sum("total_amount").alias("revenue"))
    regions = yearly.join(stores.select("store_id", "region"), "store_id").groupBy("region", "year").agg(
        F.count(F.lit(1)).alias("stores"), F.sum("revenue").alias("revenue"), mean("revenue").alias("revenue_per_store"),
        F.round(F.stddev_samp(F.col("revenue").cast("double")), 2).alias("store_std_dev"))
    prev = F.lag("revenue", 1).over(W.partitionBy("region").orderBy("year"))
    return regions.withColumn("yoy_growth_pct", growth_pct("revenue", prev))


def insight_format_density(sales: DataFrame, stores: DataFrame) -> DataFrame:
    return store_totals(sales, stores).groupBy("store_format").agg(
        F.sum("revenue").alias("revenue"), ratio(F.sum("revenue"), F.sum("size_sqft")).alias("revenue_per_sqft"))


def insight_weather_category(sales: DataFrame, products: DataFrame, weather: DataFrame) -> DataFrame:
    """Category with the highest and the lowest revenue per temperature band."""
    sold = sales.groupBy("date", "store_id", "product_id").agg(F.sum("total_amount").alias("s"))
    days = sold.join(products.select("product_id", "category"), "product_id").groupBy("date", "store_id", "category").agg(F.sum("s").alias("s"))
    band = temperature_band(avg_temperature("temp_high_f", "temp_low_f"))
    by_band = days.join(weather.select("date", "store_id", band.alias("temperature_band")), ["date", "store_id"]).groupBy(
        "temperature_band", "category").agg(F.sum("s").alias("revenue"))
    return by_band.groupBy("temperature_band").agg(
        F.max_by("category", "revenue").alias("best_category"), F.max("revenue").alias("best_revenue"),
        F.min_by("category", "revenue").alias("worst_category"), F.min("revenue").alias("worst_revenue"))


def insight_rain_effect(sales: DataFrame, weather: DataFrame) -> DataFrame:
    """Visits and basket of store days by rain."""
    days = sales.groupBy("date", "store_id").agg(
        F.count_distinct("transaction_id").alias("visits"), F.sum("total_amount").alias("s"))
    rain = (precipitation_level("precipitation_inches") != DRY).alias("is_rainy")
    groups = days.join(weather.select("date", "store_id", rain), ["date", "store_id"]).groupBy("is_rainy").agg(
        F.count(F.lit(1)).alias("store_days"), mean("visits").alias("avg_visits"),
        ratio(F.sum("s"), F.sum("visits")).alias("avg_basket"))
    return with_lift(with_lift(groups, "is_rainy", "avg_visits", "visit_lift_pct"), "is_rainy", "avg_basket", "basket_lift_pct")
