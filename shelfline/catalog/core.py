"""Sources, projections, joins, windows, sorts and scalar functions."""

from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from shelfline import schemas
from shelfline.catalog.base import query
from shelfline.catalog.reports import CATEGORY_REVENUE, COHORT_MONTHS
from shelfline.functions import calendar as cal
from shelfline.functions import exprs
from shelfline.functions.exprs import month_of, ratio
from shelfline.operators import joins, ordered, promotions
from shelfline.operators.aggregates import daily_sales_agg, total_by
from shelfline.operators.features import feat_calendar, feat_product, feat_store, feat_weather
from shelfline.operators.quality import require_columns
from shelfline.plans import reports, summaries
from shelfline.plans.incremental import append_log, log_rows, read_log
from shelfline.session import fresh_path, materialize
from shelfline.sources import tables

MONTH_REV = "m AS (SELECT CAST(date_trunc('month', date) AS DATE) AS sale_month, SUM(total_amount) AS rev FROM sales GROUP BY 1)"

# --- A: sources and sinks --------------------------------------------------------------------------


@query("load_table", "", """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders""")
def _(t):
    # Read with a declared schema: columns that it does not name are not read.
    return tables.load_table(t.spark, t.path, "orders", schema="o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE")


@query("load_sales_limited", "", """SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity, l_shipdate FROM lineitem
 ORDER BY l_orderkey, lineitem.l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity LIMIT 1000""")
def _(t):
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity"]
    return ordered.smallest_rows(tables.load_table(t.spark, t.path, "lineitem"), 1000, keys).select(*keys)


@query("date_parsing", "", """SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS date,
 CAST(o_orderdate AS DATE) + 30 AS end_date FROM orders""")
def _(t):
    text = t.raw("orders").select(
        F.col("o_orderkey").alias("order_id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
        F.date_format(F.date_add(F.col("o_orderdate").cast("date"), 30), "yyyy-MM-dd").alias("end_date"))
    return tables.parse_dates(text)


def copied(t):
    """All seven tables written as CSV, then loaded with their declared types; returns the folder."""
    source, target = fresh_path(t.spark, "csv"), fresh_path(t.spark, "tables")
    for name, df in {"sales_transactions": t.customer_sales, **{d: getattr(t, d) for d in schemas.DIMENSIONS}}.items():
        declared = T.StructType.fromDDL(schemas.TABLES[name])
        columns = [(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in declared]
        df.select(*columns).write.option("header", True).option("compression", "gzip").csv(f"{source}/{name}.csv")
    tables.bulk_copy(t.spark, source, target)
    return target


@query("bulk_copy", "customer_sales", """SELECT transaction_id, date, store_id, product_id, customer_id, CAST(quantity AS BIGINT) AS quantity, discount_applied,
 CAST(CAST(CAST(unit_price AS VARCHAR) AS DECIMAL(10,2)) AS DOUBLE) AS unit_price, CAST(discount_percent AS BIGINT) AS discount_percent,
 CAST(CAST(total_amount AS DECIMAL(12,2)) AS DOUBLE) AS total_amount, CAST(date_trunc('month', date) AS DATE) AS sale_month FROM customer_sales""")
def _(t):
    return t.spark.read.parquet(f"{copied(t)}/sales_transactions.parquet")


COPIED = {"stores": "store_id store_name region store_format size_sqft open_date", "products": "product_id product_name category subcategory unit_price unit_cost is_perishable",
          "calendar": "date year month day day_of_week is_weekend is_holiday holiday_name season", "customers": "customer_id segment lifetime_value",
          "weather": "date store_id temp_high_f temp_low_f precipitation_inches conditions", "promotions": "store_id product_id discount_percent start_date end_date"}


@query("bulk_copy_dimensions", " ".join(COPIED), " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, COUNT({c}) AS filled, COUNT(DISTINCT {c}) AS different FROM {t}" for t, cs in COPIED.items() for c in cs.split()))
def _(t):
    target, parts = copied(t), []
    for name, columns in COPIED.items():
        df = t.spark.read.parquet(f"{target}/{name}.parquet")
        parts += [df.agg(F.count(c).alias("filled"), F.count_distinct(c).alias("different")).select(
            F.lit(name).alias("table_name"), F.lit(c).alias("column_name"), "filled", "different") for c in columns.split()]
    return joins.stack(parts)


@query("write_table", "sales", """SELECT transaction_id, date, store_id, product_id, CAST(quantity AS BIGINT) AS quantity, CAST(total_amount AS DOUBLE) AS total_amount
 FROM sales UNION ALL SELECT transaction_id, date, store_id, product_id, quantity, CAST(total_amount AS DOUBLE) FROM sales""")
def _(t):
    path = fresh_path(t.spark, "written")
    part = t.sales.select("transaction_id", "date", "store_id", "product_id", "quantity", "total_amount")
    tables.write_table(part, path)
    tables.write_table(part, path, mode="append")
    return t.spark.read.schema(part.schema).parquet(path)


@query("create_table_as", "sales", """SELECT date, store_id, CAST(SUM(total_amount) AS DOUBLE) AS revenue, COUNT(*) AS lines
 FROM sales GROUP BY date, store_id""")
def _(t):
    summary = t.sales.groupBy("date", "store_id").agg(F.sum("total_amount").alias("revenue"), F.count(F.lit(1)).alias("lines"))
    path = fresh_path(t.spark, "summary")
    tables.create_table_as(summary, path)
    return tables.create_table_as(summary, path)


@query("insert_values_log", "sales stores", """SELECT 'sales_transactions' AS table_name, COUNT(*) AS row_count FROM sales
 UNION ALL SELECT 'stores', COUNT(*) FROM stores""")
def _(t):
    path = fresh_path(t.spark, "log")
    append_log(log_rows({"sales_transactions": t.sales, "stores": t.stores}), path)
    return read_log(t.spark, path).select("table_name", "row_count")


@query("parameterized_query", "sales stores", """SELECT st.region, COUNT(*) AS lines, CAST(SUM(total_amount) AS DOUBLE) AS revenue
 FROM sales s JOIN stores st ON s.store_id = st.store_id
 WHERE s.date >= DATE '1997-01-01' AND s.quantity > 10 GROUP BY st.region""")
def _(t):
    text = """SELECT st.region, COUNT(*) AS lines, SUM(total_amount) AS revenue
      FROM {sales} s JOIN {stores} st ON s.store_id = st.store_id
      WHERE s.date >= :since AND s.quantity > :least GROUP BY st.region"""
    import datetime
    return tables.parameterized_query(t.spark, text, {"since": datetime.date(1997, 1, 1), "least": 10},
                                      sales=t.sales, stores=t.stores)


# --- B: projections and predicates -----------------------------------------------------------------


@query("project_rename", "stores", """SELECT store_id, region AS store_region, store_format, CAST(size_sqft AS BIGINT) AS store_size_sqft FROM stores""")
def _(t):
    return t.stores.select("store_id", "region", "store_format", "size_sqft").withColumnsRenamed(
        {"region": "store_region", "size_sqft": "store_size_sqft"})


@query("filter_not_null", "customer_sales", "SELECT transaction_id, customer_id, date FROM customer_sales WHERE customer_id IS NOT NULL")
def _(t):
    return t.customer_sales.where(F.col("customer_id").isNotNull()).select("transaction_id", "customer_id", "date")


@query("filter_range", "customer_sales", f"""WITH {COHORT_MONTHS} SELECT cohort_month, cohort_period, COUNT(*) AS rows_kept FROM visits
 WHERE cohort_period <= 12 GROUP BY ALL""")
def _(t):
    period = exprs.months_between_starts("activity_month", "cohort_month")
    return (reports.customer_months(t.customer_sales).withColumn("cohort_period", period)
            .where(F.col("cohort_period") <= 12).groupBy("cohort_month", "cohort_period")
            .agg(F.count(F.lit(1)).alias("rows_kept")))


@query("case_bucket_temperature", "weather", """SELECT date, store_id, CASE WHEN a < 32 THEN 'Freezing (<32°F)' WHEN a < 50 THEN 'Cold (32-50°F)'
  WHEN a < 70 THEN 'Mild (50-70°F)' WHEN a < 85 THEN 'Warm (70-85°F)' ELSE 'Hot (>85°F)' END AS temperature_band
 FROM (SELECT date, store_id, (temp_high_f + temp_low_f) // 2 AS a FROM weather)""")
def _(t):
    avg = exprs.avg_temperature("temp_high_f", "temp_low_f")
    return t.weather.select("date", "store_id", exprs.temperature_band(avg).alias("temperature_band"))


@query("case_bucket_precipitation", "weather", """SELECT date, store_id, CASE WHEN precipitation_inches = 0 THEN 'No Rain'
  WHEN precipitation_inches < 0.1 THEN 'Light Rain (<0.1")' WHEN precipitation_inches < 0.5 THEN 'Moderate Rain (0.1-0.5")'
  ELSE 'Heavy Rain (>0.5")' END AS precipitation_level FROM weather""")
def _(t):
    return t.weather.select("date", "store_id", exprs.precipitation_level("precipitation_inches").alias("precipitation_level"))


def running(t):
    """Category revenue with its running total."""
    cats = (t.sales.join(t.products.select("product_id", "category", "subcategory"), "product_id")
            .groupBy("category", "subcategory").agg(F.sum("total_amount").alias("revenue")))
    return ordered.add_running_total(materialize(cats, "categories"), "revenue", "cumulative_revenue", "total_revenue")


# The running total is the sum over all categories that sold at least as much.
RUNNING = f"""sold AS ({CATEGORY_REVENUE}), shares AS (SELECT a.category, a.subcategory, SUM(b.revenue) AS up_to,
   ROUND(CAST(SUM(b.revenue) AS DOUBLE) / (SELECT CAST(SUM(revenue) AS DOUBLE) FROM sold) * 100, 2) AS pct
  FROM sold a JOIN sold b ON b.revenue >= a.revenue GROUP BY a.category, a.subcategory)"""


@query("case_abc", "products sales", f"""WITH {RUNNING} SELECT category, subcategory,
 CASE WHEN pct <= 80 THEN 'A - High Value' WHEN pct <= 95 THEN 'B - Medium Value' ELSE 'C - Low Value' END AS abc_classification FROM shares""")
def _(t):
    pct = exprs.ratio_pct("cumulative_revenue", "total_revenue")
    return running(t).select("category", "subcategory", exprs.abc_class(pct).alias("abc_classification"))


@query("case_value_segment", "customer_sales", """WITH m AS (SELECT customer_id, CAST(SUM(total_amount) AS DOUBLE) AS rev FROM customer_sales
   WHERE customer_id IS NOT NULL GROUP BY 1),
 q AS (SELECT PERCENTILE_CONT(0.8) WITHIN GROUP (ORDER BY rev) AS hi, PERCENTILE_CONT(0.5) WITHIN GROUP (ORDER BY rev) AS mid FROM m)
 SELECT customer_id, CASE WHEN rev >= hi THEN 'High Value' WHEN rev >= mid THEN 'Medium Value' ELSE 'Low Value' END AS value_segment FROM m, q""")
def _(t):
    return summaries.summary_customer_segments(t.customer_sales).select("customer_id", "value_segment")


@query("case_frequency_segment", "customer_sales", """WITH m AS (SELECT customer_id, COUNT(DISTINCT transaction_id) AS n FROM customer_sales
   WHERE customer_id IS NOT NULL GROUP BY 1)
 SELECT customer_id, CASE WHEN n >= 10 THEN 'Loyal' WHEN n >= 3 THEN 'Regular' ELSE 'New' END AS frequency_segment FROM m""")
def _(t):
    orders = t.customer_sales.where(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        F.count_distinct("transaction_id").alias("n"))
    return orders.select("customer_id", exprs.frequency_segment("n").alias("frequency_segment"))


@query("case_guarded_growth", "sales", f"""WITH {MONTH_REV}, p AS (SELECT sale_month, rev, LAG(rev) OVER (ORDER BY sale_month) AS prev FROM m)
 SELECT sale_month, CASE WHEN prev > 0 THEN ROUND(CAST(rev - prev AS DOUBLE) / CAST(prev AS DOUBLE) * 100, 2) END AS growth_pct FROM p""")
def _(t):
    prev = F.lag("rev").over(W.orderBy("sale_month"))
    return monthly(t).select("sale_month", exprs.growth_pct("rev", prev).alias("growth_pct"))


@query("drop_na_subset", "daily", """SELECT date, CAST(store_id AS BIGINT) AS store_id, CAST(product_id AS BIGINT) AS product_id, CAST(lag7 AS DOUBLE) AS sales_lag_7 FROM
 (SELECT *, LAG(daily_revenue, 7) OVER (PARTITION BY store_id, product_id ORDER BY date) AS lag7 FROM daily) WHERE lag7 IS NOT NULL""")
def _(t):
    w = W.partitionBy("store_id", "product_id").orderBy("date")
    lagged = daily_sales_agg(t.series_sales).withColumn("sales_lag_7", F.lag("daily_revenue", 7).over(w))
    return lagged.dropna(subset=["sales_lag_7"]).select("date", "store_id", "product_id", "sales_lag_7")


@query("fill_na", "customer_sales", """SELECT transaction_id, COALESCE(customer_id, 0) AS customer_id, CAST(quantity AS BIGINT) AS quantity FROM customer_sales""")
def _(t):
    return t.customer_sales.select("transaction_id", "customer_id", "quantity").fillna(0)


@query("require_columns", "sales", "SELECT transaction_id, date, store_id, product_id FROM sales")
def _(t):
    cols = ["transaction_id", "date", "store_id", "product_id"]
    return require_columns(t.sales, cols, "sales").select(*cols)


@query("constant_columns_if_absent", "sales", "SELECT transaction_id, FALSE AS has_promotion, CAST(0 AS BIGINT) AS promotion_discount FROM sales")
def _(t):
    from shelfline.operators.features import fill_promotion
    return fill_promotion(t.sales.select("transaction_id"))


# --- C: joins -----------------------------------------------------------------------------------------


@query("join_inner_star", "sales stores products", """SELECT s.transaction_id, s.product_id, CAST(s.quantity AS BIGINT) AS quantity, st.region, st.store_format, p.category, p.subcategory
 FROM sales s JOIN stores st ON s.store_id = st.store_id JOIN products p ON s.product_id = p.product_id""")
def _(t):
    return joins.star_join(t.sales, t.stores, t.products).select(
        "transaction_id", "product_id", "quantity", "region", "store_format", "category", "subcategory")


@query("join_left_preserve_dim", "", """SELECT d.doc_id, d.source, CAST(SUM(l.quality) AS BIGINT) AS good, COUNT(l.doc_id) AS labels
 FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY d.doc_id, d.source""")
def _(t):
    # Labels cover only some documents, so unmatched rows of the kept side are real.
    return joins.preserve_dimension(t.raw("documents").select("doc_id", "source"), t.raw("labels"), "doc_id",
                                    good=F.sum("quality"), labels=F.count("doc_id")).withColumn("labels", F.coalesce("labels", F.lit(0)))


@query("join_composite_key", "sales weather", """WITH d AS (SELECT date, store_id, SUM(total_amount) AS rev FROM sales GROUP BY 1, 2)
 SELECT d.date, d.store_id, CAST(rev AS DOUBLE) AS daily_revenue, w.conditions, CAST(w.temp_high_f AS BIGINT) AS temp_high_f
 FROM d JOIN weather w ON d.date = w.date AND d.store_id = w.store_id""")
def _(t):
    daily = total_by(t.sales, ["date", "store_id"], daily_revenue="total_amount")
    return daily.join(t.weather.select("date", "store_id", "conditions", "temp_high_f"), ["date", "store_id"])


@query("join_left_enrich", "daily calendar series_stores series_products series_weather", """SELECT d.date, CAST(d.store_id AS BIGINT) AS store_id, CAST(d.product_id AS BIGINT) AS product_id,
  c.day_of_week, c.season, st.region AS store_region, CAST(st.size_sqft AS BIGINT) AS store_size_sqft, p.category AS product_category,
  CAST(p.unit_price AS DOUBLE) AS product_price, w.conditions AS weather_conditions
 FROM daily d LEFT JOIN calendar c ON d.date = c.date LEFT JOIN series_stores st ON d.store_id = st.store_id
 LEFT JOIN series_products p ON d.product_id = p.product_id LEFT JOIN series_weather w ON d.date = w.date AND d.store_id = w.store_id""")
def _(t):
    df = daily_sales_agg(t.series_sales).select("date", "store_id", "product_id")
    df = feat_weather(feat_product(feat_store(feat_calendar(df, t.calendar), t.series_stores), t.series_products), t.series_weather)
    return df.select("date", "store_id", "product_id", "day_of_week", "season", "store_region", "store_size_sqft",
                     "product_category", "product_price", "weather_conditions")


@query("join_cross_scalar", "products sales", f"""SELECT category, subcategory, CAST(revenue AS DOUBLE) AS revenue, CAST(SUM(revenue) OVER () AS DOUBLE) AS grand_total FROM ({CATEGORY_REVENUE})""")
def _(t):
    cats = total_by(t.sales, ["product_id"], revenue="total_amount").join(
        t.products.select("product_id", "category", "subcategory"), "product_id")
    return joins.with_grand_total(total_by(cats, ["category", "subcategory"], revenue="revenue"), "revenue", "grand_total")


def store_revenue(t):
    return total_by(t.sales, ["store_id"], rev="total_amount").join(
        t.stores.select("store_id", "region", "store_format"), "store_id")


STORE_REV = """s AS (SELECT st.store_id, st.region, st.store_format, SUM(total_amount) AS rev FROM stores st JOIN sales sa ON st.store_id = sa.store_id GROUP BY 1, 2, 3)"""


@query("join_benchmark", "stores sales", f"""WITH {STORE_REV}, b AS (SELECT region, CAST(SUM(rev) AS DOUBLE) / COUNT(rev) AS region_mean FROM s GROUP BY region)
 SELECT s.store_id, s.region, CAST(rev AS DOUBLE) AS rev, region_mean FROM s JOIN b ON s.region = b.region""")
def _(t):
    return joins.with_group_mean(store_revenue(t).drop("store_format"), "region", "rev", "region_mean")


@query("join_cohort", "customer_sales", f"""WITH {COHORT_MONTHS} SELECT customer_id, cohort_month, cohort_period, CAST(monthly_spend AS DOUBLE) AS monthly_spend,
 monthly_transactions, COUNT(*) FILTER (cohort_period = 0) OVER (PARTITION BY cohort_month) AS cohort_size FROM visits""")
def _(t):
    months = reports.customer_months(t.customer_sales)
    first = F.col("activity_month") == F.col("cohort_month")
    sizes = months.where(first).groupBy("cohort_month").agg(F.count(F.lit(1)).alias("cohort_size"))
    return months.join(sizes, "cohort_month").select(
        "customer_id", "cohort_month", exprs.months_between_starts("activity_month", "cohort_month").alias("cohort_period"),
        "monthly_spend", "monthly_transactions", "cohort_size")


@query("anti_join_orphans", "", """SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def _(t):
    return joins.orphans(t.raw("documents").select("doc_id", "source"), t.raw("labels"), "doc_id")


@query("promo_range_join", "sales promotions", """SELECT transaction_id, date, store_id, product_id, CAST(quantity AS BIGINT) AS quantity, EXISTS (SELECT 1 FROM promotions p
   WHERE p.store_id = s.store_id AND p.product_id = s.product_id AND s.date BETWEEN p.start_date AND p.end_date) AS in_promotion FROM sales s""")
def _(t):
    keys = ["transaction_id", "date", "store_id", "product_id", "quantity"]
    return promotions.promo_range_join(t.sales.select(*keys), t.promotions).select(*keys, "in_promotion")


@query("promo_effective_price", "sales products promotions", """WITH b AS (SELECT row_number() OVER () AS rid, s.transaction_id, s.date, s.store_id, s.product_id, s.quantity,
   p.unit_price AS base_price FROM sales s JOIN products p ON s.product_id = p.product_id),
 d AS (SELECT b.*, COALESCE((SELECT MAX(discount_percent) FROM promotions q WHERE q.store_id = b.store_id AND q.product_id = b.product_id
   AND b.date BETWEEN q.start_date AND q.end_date), 0) AS pct FROM b),
 p AS (SELECT *, ROUND(CAST(base_price AS DECIMAL(12,2)) * CAST(100 - pct AS DECIMAL(3,0)) * CAST(0.01 AS DECIMAL(3,2)), 2) AS price FROM d)
 SELECT transaction_id, date, store_id, product_id, CAST(quantity AS BIGINT) AS quantity, CAST(price AS DOUBLE) AS unit_price, CAST(ROUND(price * quantity, 2) AS DOUBLE) AS total_amount,
  pct > 0 AS discount_applied, CAST(pct AS BIGINT) AS discount_percent FROM p""")
def _(t):
    base = t.sales.select("transaction_id", "date", "store_id", "product_id", "quantity").join(
        t.products.select("product_id", F.col("unit_price").alias("base_price")), "product_id")
    return promotions.promo_effective_price(base, t.promotions).drop("base_price")


@query("scalar_subquery", "sales", """SELECT store_id, CAST(SUM(total_amount) AS DOUBLE) AS revenue,
  (SELECT COUNT(*) FROM sales) AS all_rows, (SELECT MAX(date) FROM sales) AS last_date FROM sales GROUP BY store_id""")
def _(t):
    facts = t.sales.agg(F.count(F.lit(1)).alias("n"), F.max("date").alias("d"))
    return total_by(t.sales, ["store_id"], revenue="total_amount").withColumns(
        {"all_rows": facts.select("n").scalar(), "last_date": facts.select("d").scalar()})


@query("correlated_not_exists", "", """SELECT doc_id, lang FROM documents d WHERE NOT EXISTS
 (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality = 1)""")
def _(t):
    return tables.parameterized_query(
        t.spark, "SELECT doc_id, lang FROM {docs} d WHERE NOT EXISTS (SELECT 1 FROM {labels} l WHERE l.doc_id = d.doc_id AND l.quality = :good)",
        args={"good": 1}, docs=t.raw("documents"), labels=t.raw("labels"))


# --- E: windows -----------------------------------------------------------------------------------------


def monthly(t):
    """One row per calendar month; windows over it see at most a few hundred rows."""
    return t.sales.groupBy(month_of("date").alias("sale_month")).agg(F.sum("total_amount").alias("rev"))


def _lag_query(n):
    @query(f"win_lag_{n}", "sales", f"""WITH {MONTH_REV} SELECT sale_month, CAST(rev AS DOUBLE) AS rev, CAST(LAG(rev, {n}) OVER (ORDER BY sale_month) AS DOUBLE) AS prev FROM m""")
    def _(t):
        return monthly(t).withColumn("prev", F.lag("rev", n).over(W.orderBy("sale_month")))


_lag_query(1)
_lag_query(12)


@query("win_rolling_3m", "sales", f"""WITH {MONTH_REV} SELECT sale_month, CAST(SUM(rev) OVER w AS DOUBLE) / COUNT(rev) OVER w AS rolling_3m
 FROM m WINDOW w AS (ORDER BY sale_month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""")
def _(t):
    w = W.orderBy("sale_month").rowsBetween(-2, 0)
    return monthly(t).select("sale_month", ratio(F.sum("rev").over(w), F.count("rev").over(w)).alias("rolling_3m"))


@query("win_ytd", "sales", f"""WITH {MONTH_REV} SELECT sale_month, CAST(SUM(rev) OVER (PARTITION BY year(sale_month) ORDER BY sale_month) AS DOUBLE) AS ytd FROM m""")
def _(t):
    return monthly(t).select("sale_month", F.sum("rev").over(W.partitionBy(F.year("sale_month")).orderBy("sale_month")).alias("ytd"))


@query("win_rank", "stores sales", f"WITH {STORE_REV} SELECT store_id, RANK() OVER (ORDER BY rev DESC NULLS LAST) AS overall_rank FROM s")
def _(t):
    df = materialize(store_revenue(t), "stores")
    return ordered.add_rank(df, "rev", "overall_rank").select("store_id", "overall_rank")


@query("win_dense_rank", "stores sales", f"WITH {STORE_REV} SELECT store_id, DENSE_RANK() OVER (ORDER BY rev DESC NULLS LAST) AS dense_rank FROM s")
def _(t):
    df = materialize(store_revenue(t), "stores")
    return ordered.add_rank(df, "rev", "dense_rank", dense=True).select("store_id", "dense_rank")


@query("win_rank_partitioned", "stores sales", f"""WITH {STORE_REV} SELECT store_id, region, store_format,
  RANK() OVER (PARTITION BY region ORDER BY rev DESC NULLS LAST) AS regional_rank,
  RANK() OVER (PARTITION BY store_format ORDER BY rev DESC NULLS LAST) AS format_rank FROM s""")
def _(t):
    df = materialize(store_revenue(t), "stores")
    ranked = ordered.add_rank(df, "rev", "regional_rank", by=["region"], of=df)
    return ordered.add_rank(ranked, "rev", "format_rank", by=["store_format"], of=df).drop("rev")


@query("win_ntile", "stores sales", f"WITH {STORE_REV} SELECT store_id, NTILE(4) OVER (ORDER BY rev DESC NULLS LAST, store_id) AS quartile FROM s")
def _(t):
    df = materialize(store_revenue(t), "stores")
    return ordered.add_ntile(df, "rev", "store_id", 4, "quartile").select("store_id", "quartile")


@query("win_percent_rank", "stores sales", f"WITH {STORE_REV} SELECT store_id, ROUND(PERCENT_RANK() OVER (ORDER BY rev ASC NULLS LAST) * 100, 1) AS percentile FROM s")
def _(t):
    df = materialize(store_revenue(t), "stores")
    df = ordered.add_percent_rank(df, "rev", "p")
    return df.select("store_id", F.round(F.col("p") * 100, 1).alias("percentile"))


@query("win_cumulative", "products sales", f"""WITH {RUNNING} SELECT category, subcategory, CAST(up_to AS DOUBLE) AS cumulative_revenue, pct AS cumulative_pct FROM shares""")
def _(t):
    return running(t).select("category", "subcategory", "cumulative_revenue",
                                   exprs.ratio_pct("cumulative_revenue", "total_revenue").alias("cumulative_pct"))


COHORT_MATRIX = f"""{COHORT_MONTHS}, matrix AS (SELECT cohort_month, cohort_period, COUNT(*) AS active, SUM(monthly_spend) AS revenue,
   SUM(COUNT(*) FILTER (cohort_period = 0)) OVER (PARTITION BY cohort_month) AS members FROM visits GROUP BY cohort_month, cohort_period)"""


def cohort_matrix(t):
    period = exprs.months_between_starts("activity_month", "cohort_month")
    return reports.customer_months(t.customer_sales).groupBy("cohort_month", period.alias("cohort_period")).agg(
        F.count(F.lit(1)).alias("active"), F.sum("monthly_spend").alias("rev"))


@query("win_cohort_cumulative", "customer_sales", f"""WITH {COHORT_MATRIX} SELECT cohort_month, cohort_period,
  CAST(SUM(revenue) OVER (PARTITION BY cohort_month ORDER BY cohort_period) AS DOUBLE) / members AS cumulative_per_customer FROM matrix""")
def _(t):
    cohort = W.partitionBy("cohort_month")
    size = F.max(F.when(F.col("cohort_period") == 0, F.col("active"))).over(cohort)
    return cohort_matrix(t).select("cohort_month", "cohort_period", ratio(
        F.sum("rev").over(cohort.orderBy("cohort_period")), size).alias("cumulative_per_customer"))


@query("win_cohort_delta", "customer_sales", f"""WITH {COHORT_MATRIX}, kept AS (SELECT cohort_month, cohort_period, active, ROUND(CAST(active AS DOUBLE) / members * 100, 2) AS rate FROM matrix)
 SELECT cohort_month, cohort_period, active - LAG(active) OVER w AS active_change, ROUND(rate - LAG(rate) OVER w, 2) AS retention_change_ppt
 FROM kept WINDOW w AS (PARTITION BY cohort_month ORDER BY cohort_period)""")
def _(t):
    cohort = W.partitionBy("cohort_month")
    w = cohort.orderBy("cohort_period")
    size = F.max(F.when(F.col("cohort_period") == 0, F.col("active"))).over(cohort)
    rated = cohort_matrix(t).withColumn("rate", exprs.ratio_pct("active", size))
    return rated.select("cohort_month", "cohort_period", (F.col("active") - F.lag("active").over(w)).alias("active_change"),
                        F.round(F.col("rate") - F.lag("rate").over(w), 2).alias("retention_change_ppt"))


# --- F: sorts, limits, set operations ---------------------------------------------------------------------


@query("order_by_multi", "sales", "SELECT store_id, date, CAST(SUM(total_amount) AS DOUBLE) AS revenue FROM sales GROUP BY 1, 2 ORDER BY store_id, revenue DESC NULLS LAST")
def _(t):
    return total_by(t.sales, ["store_id", "date"], revenue="total_amount").orderBy(
        F.col("store_id").asc_nulls_last(), F.col("revenue").desc_nulls_last())


@query("limit_latest", "", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date, o_totalprice FROM orders ORDER BY o_orderdate DESC NULLS LAST, o_orderkey LIMIT 10")
def _(t):
    return t.raw("orders").orderBy(F.col("o_orderdate").desc_nulls_last(), "o_orderkey").limit(10).select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("order_date"), "o_totalprice")


@query("top_k", "stores sales", f"WITH {STORE_REV} SELECT store_id, region, CAST(rev AS DOUBLE) AS rev FROM s ORDER BY rev DESC NULLS LAST, store_id LIMIT 10")
def _(t):
    return store_revenue(t).drop("store_format").orderBy(F.col("rev").desc_nulls_last(), "store_id").limit(10)


@query("arg_max_min", "sales", f"""WITH {MONTH_REV} SELECT max_by(sale_month, rev) AS best_month, min_by(sale_month, rev) AS worst_month,
 CAST(MAX(rev) AS DOUBLE) AS best_revenue, CAST(MIN(rev) AS DOUBLE) AS worst_revenue FROM m""")
def _(t):
    return monthly(t).agg(F.max_by("sale_month", "rev").alias("best_month"), F.min_by("sale_month", "rev").alias("worst_month"),
                          F.max("rev").alias("best_revenue"), F.min("rev").alias("worst_revenue"))


@query("union_all", "stores sales", f"""WITH {STORE_REV} SELECT 'By Region' AS analysis_type, region AS category, COUNT(*) AS stores, CAST(SUM(rev) AS DOUBLE) AS revenue FROM s GROUP BY region
 UNION ALL SELECT 'By Format', store_format, NULL, CAST(SUM(rev) AS DOUBLE) FROM s GROUP BY store_format""")
def _(t):
    s = store_revenue(t)
    region = s.groupBy(F.col("region").alias("category")).agg(F.count(F.lit(1)).alias("stores"), F.sum("rev").alias("revenue"))
    fmt = s.groupBy(F.col("store_format").alias("category")).agg(F.sum("rev").alias("revenue"))
    return joins.stack([region.withColumn("analysis_type", F.lit("By Region")), fmt.withColumn("analysis_type", F.lit("By Format"))])


@query("set_difference", "", "SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels")
def _(t):
    return joins.missing_keys(t.raw("documents"), t.raw("labels"), "doc_id")


@query("sample", "", """SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY md5('42|' || o_orderkey), o_orderkey LIMIT 1000""")
def _(t):
    from shelfline.operators.sampling import sample_rows
    return sample_rows(t.raw("orders").select("o_orderkey", "o_custkey", "o_totalprice"), 1000, seed=42, key=["o_orderkey"])


# --- G: scalar functions --------------------------------------------------------------------------------------


@query("fn_date_trunc", "sales", """SELECT transaction_id, date, CAST(date_trunc('month', date) AS DATE) AS month_start, CAST(date_trunc('week', date) AS DATE) AS week_start FROM sales""")
def _(t):
    return t.sales.select("transaction_id", "date", month_of("date").alias("month_start"), exprs.week_of("date").alias("week_start"))


@query("fn_extract", "sales", "SELECT date, year(date) AS year, month(date) AS month, week(date) AS week, COUNT(*) AS lines FROM sales GROUP BY date")
def _(t):
    return t.sales.groupBy("date").agg(F.count(F.lit(1)).alias("lines")).select(
        "date", F.year("date").alias("year"), F.month("date").alias("month"), F.weekofyear("date").alias("week"), "lines")


@query("fn_date_diff", "customer_sales", """SELECT customer_id, CAST(MAX(date) - MIN(date) AS BIGINT) AS tenure_days FROM customer_sales
 WHERE customer_id IS NOT NULL GROUP BY customer_id""")
def _(t):
    return t.customer_sales.where(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        F.datediff(F.max("date"), F.min("date")).alias("tenure_days"))


@query("fn_month_diff", "sales", """SELECT store_id, date, datediff('month', CAST(date_trunc('month', (SELECT MIN(date) FROM sales)) AS DATE),
  CAST(date_trunc('month', date) AS DATE)) AS months_since FROM (SELECT DISTINCT store_id, date FROM sales)""")
def _(t):
    first = month_of(t.sales.agg(F.min("date").alias("d")).scalar())
    return t.sales.select("store_id", "date").distinct().select(
        "store_id", "date", exprs.months_between_starts(month_of("date"), first).alias("months_since"))


@query("fn_round_nullif", "stores sales", f"""WITH {STORE_REV} SELECT s.store_id, ROUND(CAST(rev AS DOUBLE) / NULLIF(size_sqft, 0), 2) AS per_sqft,
  ROUND(CAST(rev AS DOUBLE) / NULLIF(s.store_id % 4, 0), 2) AS guarded FROM s JOIN stores st ON s.store_id = st.store_id""")
def _(t):
    df = store_revenue(t).join(t.stores.select("store_id", "size_sqft"), "store_id")
    return df.select("store_id", F.round(ratio("rev", "size_sqft"), 2).alias("per_sqft"),
                     F.round(ratio("rev", F.col("store_id") % 4), 2).alias("guarded"))


@query("fn_cast_decimal", "products sales", """SELECT category, subcategory, ROUND(CAST(SUM(quantity) AS DOUBLE) / nullif(COUNT(DISTINCT transaction_id), 0), 4) AS basket
 FROM sales JOIN products USING (product_id) GROUP BY ALL""")
def _(t):
    return reports.category_sales(t.products, t.sales).select(
        "category", "subcategory", F.round(ratio(F.col("category_units").cast("decimal(38,6)"), "category_transactions"), 4).alias("basket"))


@query("fn_avg_temp", "weather", """SELECT date, store_id, CAST((temp_high_f + temp_low_f) // 2 AS BIGINT) AS whole_avg, (temp_high_f + temp_low_f) / 2 AS true_avg FROM weather""")
def _(t):
    return t.weather.select("date", "store_id", exprs.avg_temperature("temp_high_f", "temp_low_f").alias("whole_avg"),
                            exprs.avg_temperature("temp_high_f", "temp_low_f", whole=False).alias("true_avg"))


@query("fn_calendar_parts", "calendar sales", """SELECT s.transaction_id, s.date, day_of_week, day_name, week_of_year, quarter, is_weekend, is_month_start, is_month_end
 FROM sales s JOIN calendar c ON s.date = c.date""")
def _(t):
    parts = cal.calendar_parts("date")
    names = ["day_of_week", "day_name", "week_of_year", "quarter", "is_weekend", "is_month_start", "is_month_end"]
    return t.sales.select("transaction_id", "date", *[parts[n].alias(n) for n in names])


@query("fn_nth_weekday", "sales", """SELECT month_start, month_start + CAST((8 - isodow(month_start)) % 7 AS INTEGER) + 14 AS third_monday,
  month_start + CAST((11 - isodow(month_start)) % 7 AS INTEGER) + 21 AS fourth_thursday, lines
 FROM (SELECT CAST(date_trunc('month', date) AS DATE) AS month_start, COUNT(*) AS lines FROM sales GROUP BY 1)""")
def _(t):
    months = t.sales.groupBy(month_of("date").alias("month_start")).agg(F.count(F.lit(1)).alias("lines"))
    m = F.col("month_start")
    return months.select("month_start", cal.nth_weekday(m, "MON", 3).alias("third_monday"),
                         cal.nth_weekday(m, "THU", 4).alias("fourth_thursday"), "lines")


@query("fn_last_weekday", "sales", """SELECT month_start, last_day(month_start) - CAST(isodow(last_day(month_start)) - 1 AS INTEGER) AS last_monday, lines
 FROM (SELECT CAST(date_trunc('month', date) AS DATE) AS month_start, COUNT(*) AS lines FROM sales GROUP BY 1)""")
def _(t):
    months = t.sales.groupBy(month_of("date").alias("month_start")).agg(F.count(F.lit(1)).alias("lines"))
    return months.select("month_start", cal.last_weekday(F.col("month_start"), "MON").alias("last_monday"), "lines")


@query("fn_season", "sales calendar", "SELECT season, COUNT(*) AS lines FROM sales s JOIN calendar c ON s.date = c.date GROUP BY season")
def _(t):
    return t.sales.groupBy(cal.season("date").alias("season")).agg(F.count(F.lit(1)).alias("lines"))


@query("fn_days_to_holiday", "sales calendar", "SELECT s.date, days_to_holiday, COUNT(*) AS lines FROM sales s JOIN calendar c ON s.date = c.date GROUP BY 1, 2")
def _(t):
    days = t.sales.groupBy("date").agg(F.count(F.lit(1)).alias("lines"))
    return days.select("date", cal.days_to_holiday("date").alias("days_to_holiday"), "lines")


@query("fn_label_encode", "stores", """SELECT store_id, store_format, DENSE_RANK() OVER (ORDER BY store_format) - 1 AS code FROM stores""")
def _(t):
    from shelfline.operators.encoding import fit_label_codes
    df = t.stores.select("store_id", "store_format")
    return fit_label_codes(df, ["store_format"]).transform(df).withColumnRenamed("store_format_code", "code")


@query("fn_clip_round", "sales", """SELECT transaction_id, ROUND(GREATEST(0.0, CAST(quantity - 25 AS DOUBLE) / 7), 2) AS clipped FROM sales""")
def _(t):
    return t.sales.select("transaction_id", exprs.clip_round((F.col("quantity") - 25).cast("double") / 7).alias("clipped"))


@query("fn_coalesce_default", "customer_sales", "SELECT transaction_id, COALESCE(customer_id, -1) AS customer_id FROM customer_sales")
def _(t):
    return t.customer_sales.select("transaction_id", F.coalesce("customer_id", F.lit(-1)).alias("customer_id"))
