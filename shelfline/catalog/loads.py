"""Data-quality checks and incremental loads."""

from pyspark.sql import functions as F

from shelfline.catalog.base import query
from shelfline.operators import quality
from shelfline.plans import incremental as inc
from shelfline.session import fresh_path
from shelfline.sources import versions
from shelfline.streaming import incremental as stream


@query("dq_nulls", "customer_sales", """SELECT 'null_' || c AS check_name, n AS issue_count FROM (
  SELECT 'customer_id' AS c, COUNT(*) - COUNT(customer_id) AS n FROM customer_sales UNION ALL
  SELECT 'date', COUNT(*) - COUNT(date) FROM customer_sales UNION ALL
  SELECT 'store_id', COUNT(*) - COUNT(store_id) FROM customer_sales UNION ALL
  SELECT 'total_amount', COUNT(*) - COUNT(total_amount) FROM customer_sales)""")
def _(t):
    return quality.dq_nulls(t.customer_sales, ["customer_id", "date", "store_id", "total_amount"])


@query("dq_negative", "sales", """SELECT 'negative_quantity' AS check_name, COUNT(*) FILTER (quantity < 0) AS issue_count FROM sales UNION ALL
 SELECT 'negative_total_amount', COUNT(*) FILTER (total_amount < 0) FROM sales UNION ALL
 SELECT 'negative_s_acctbal', COUNT(*) FILTER (s_acctbal < 0) FROM supplier UNION ALL
 SELECT 'negative_c_acctbal', COUNT(*) FILTER (c_acctbal < 0) FROM customer""")
def _(t):
    return quality.all_checks([quality.dq_negative(t.sales, ["quantity", "total_amount"]),
                               quality.dq_negative(t.raw("supplier"), ["s_acctbal"]),
                               quality.dq_negative(t.raw("customer"), ["c_acctbal"])])


@query("dq_duplicate_keys", "", """SELECT 'duplicate_lines' AS check_name, COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS issue_count
  FROM lineitem UNION ALL SELECT 'duplicate_orders', COUNT(*) - COUNT(DISTINCT o_orderkey) FROM orders""")
def _(t):
    return quality.all_checks([
        quality.dq_duplicate_keys(t.raw("lineitem"), ["l_orderkey", "l_linenumber"], "duplicate_lines"),
        quality.dq_duplicate_keys(t.raw("orders"), "o_orderkey", "duplicate_orders")])


@query("dq_orphans", "customer_sales stores products", """SELECT 'orphaned_store_ids' AS check_name, COUNT(*) AS issue_count FROM customer_sales s
  WHERE NOT EXISTS (SELECT 1 FROM stores st WHERE st.store_id = s.store_id)
 UNION ALL SELECT 'orphaned_product_ids', COUNT(*) FROM customer_sales s WHERE NOT EXISTS (SELECT 1 FROM products p WHERE p.product_id = s.product_id)
 UNION ALL SELECT 'orphaned_customer_ids', COUNT(*) FROM customer_sales s WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = s.customer_id)
 UNION ALL SELECT 'orphaned_user_ids', COUNT(*) FROM events e WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = e.user_id)""")
def _(t):
    return quality.all_checks([
        quality.dq_orphans(t.customer_sales, t.stores, "store_id"),
        quality.dq_orphans(t.customer_sales, t.products, "product_id"),
        quality.dq_orphans(t.customer_sales, t.customers, "customer_id"),
        quality.dq_orphans(t.raw("events"), t.customers, "user_id", "customer_id")])


@query("dq_bounds", "sales stores products", """SELECT 'date_out_of_range' AS check_name, COUNT(*) FILTER (NOT date BETWEEN DATE '1996-01-01' AND DATE '2030-12-31') AS issue_count FROM sales
 UNION ALL SELECT 'unit_price_out_of_range', COUNT(*) FILTER (NOT unit_price BETWEEN 0.0 AND 10000.0) FROM sales
 UNION ALL SELECT 'product_price_out_of_range', COUNT(*) FILTER (unit_price <= 0 OR unit_price >= 1000) FROM products
 UNION ALL SELECT 'size_sqft_out_of_range', COUNT(*) FILTER (size_sqft < 10000 OR size_sqft >= 100000) FROM stores
 UNION ALL SELECT 'quantity_q99_too_high', CAST(PERCENTILE_CONT(0.99) WITHIN GROUP (ORDER BY quantity) >= 40 AS BIGINT) FROM sales""")
def _(t):
    import datetime
    Range = quality.Range
    priced = t.products.withColumnRenamed("unit_price", "product_price")
    return quality.all_checks([
        quality.dq_bounds(t.sales, {"date": Range(datetime.date(1996, 1, 1), datetime.date(2030, 12, 31)), "unit_price": Range(0.0, 10000.0)},
                          {"quantity": (0.99, 40)}),
        quality.dq_bounds(priced, {"product_price": Range(0, 1000, low_open=True, high_open=True)}),
        quality.dq_bounds(t.stores, {"size_sqft": Range(10000, 100000, high_open=True)})])


@query("dq_completeness", "sales stores products calendar", """SELECT 'too_few_stores' AS check_name, CAST(COUNT(*) < 5 AS BIGINT) AS issue_count FROM stores
 UNION ALL SELECT 'too_few_products', CAST(COUNT(*) < 10 AS BIGINT) FROM products
 UNION ALL SELECT 'too_few_calendar', CAST(COUNT(*) < 1 AS BIGINT) FROM calendar
 UNION ALL SELECT 'too_few_sales_transactions', CAST(COUNT(*) < 100000000 AS BIGINT) FROM sales
 UNION ALL SELECT 'missing_returns', 1
 UNION ALL SELECT 'short_span_calendar', CAST(MAX(date) - MIN(date) < 365 AS BIGINT) FROM calendar""")
def _(t):
    return quality.dq_completeness(
        {"stores": t.stores, "products": t.products, "calendar": t.calendar, "sales_transactions": t.sales, "returns": None},
        {"stores": 5, "products": 10, "sales_transactions": 100_000_000}, ("calendar", "date", 365))


@query("dq_profile", "customer_sales", """SELECT 'customer_id' AS column_name, 'bigint' AS data_type, COUNT(*) AS row_count, COUNT(*) - COUNT(customer_id) AS missing FROM customer_sales
 UNION ALL SELECT 'date', 'date', COUNT(*), COUNT(*) - COUNT(date) FROM customer_sales
 UNION ALL SELECT 'quantity', 'int', COUNT(*), COUNT(*) - COUNT(quantity) FROM customer_sales""")
def _(t):
    return quality.dq_profile(t.customer_sales.select("customer_id", "date", "quantity"))


@query("dq_price_gt_cost", "products", "SELECT 'price_not_above_cost' AS check_name, COUNT(*) FILTER (NOT unit_price > unit_cost) AS issue_count FROM products")
def _(t):
    return quality.dq_price_gt_cost(t.products)


# --- incremental load: orders before 2000 are loaded, orders since 1999 arrive with changes ----------------

SPLIT = """old AS (SELECT * FROM order_sales WHERE date < DATE '2000-01-01'),
 staged AS (SELECT transaction_id, date, customer_id, quantity + 1 AS quantity, CASE WHEN status = 'F' THEN NULL ELSE discount_percent END AS discount_percent,
   total_amount * 2 AS total_amount, 'N' AS status FROM order_sales WHERE date >= DATE '1999-01-01')"""
MERGED = """SELECT COALESCE(o.transaction_id, n.transaction_id) AS transaction_id, COALESCE(o.date, n.date) AS date,
  COALESCE(o.customer_id, n.customer_id) AS customer_id,
  CAST(CASE WHEN n.transaction_id IS NOT NULL THEN n.quantity ELSE o.quantity END AS BIGINT) AS quantity,
  CAST(CASE WHEN n.transaction_id IS NOT NULL THEN n.discount_percent ELSE o.discount_percent END AS BIGINT) AS discount_percent,
  CAST(CASE WHEN n.transaction_id IS NOT NULL THEN n.total_amount ELSE o.total_amount END AS DOUBLE) AS total_amount,
  COALESCE(o.status, n.status) AS status
 FROM old o FULL OUTER JOIN staged n ON o.transaction_id = n.transaction_id"""


def _loaded(t):
    return t.order_sales.where(F.col("date") < F.lit("2000-01-01").cast("date"))


def _arriving(t):
    rows = t.order_sales.where(F.col("date") >= F.lit("1999-01-01").cast("date"))
    return rows.withColumns({
        "quantity": F.col("quantity") + 1,
        "discount_percent": F.when(F.col("status") != "F", F.col("discount_percent")),
        "total_amount": (F.col("total_amount") * 2).cast("decimal(14,2)"),
        "status": F.lit("N")})


def _as_target(df):
    return df.withColumn("total_amount", F.col("total_amount").cast("decimal(14,2)"))


def _with_year(df):
    return df.withColumn("sale_year", F.year("date"))


def _paths(t):
    base = fresh_path(t.spark, "load")
    return inc.LoadPaths(f"{base}/table", f"{base}/watermark", f"{base}/log", "orders", partition_col="sale_year")


@query("incremental_filter", "order_sales", """SELECT transaction_id, date, CAST(quantity AS BIGINT) AS quantity FROM order_sales
 WHERE transaction_id > (SELECT COALESCE(MAX(transaction_id), 0) FROM order_sales WHERE date < DATE '1995-01-10')""")
def _(t):
    early = t.order_sales.where(F.col("date") < F.lit("1995-01-10").cast("date"))
    mark = inc.watermark_update(early, inc.initial_watermark(t.spark, "orders"))
    return inc.incremental_filter(t.order_sales.select("transaction_id", "date", "quantity"), mark)


@query("staging_checks", "sales stores products", """SELECT 'null_required' AS check_name, COUNT(*) FILTER (transaction_id IS NULL OR date IS NULL OR store_id IS NULL OR product_id IS NULL) AS issue_count FROM sales
 UNION ALL SELECT 'duplicate_keys', COUNT(*) - COUNT(DISTINCT transaction_id) FROM sales
 UNION ALL SELECT 'orphaned_store_ids', COUNT(*) FROM sales s WHERE NOT EXISTS (SELECT 1 FROM stores st WHERE st.store_id = s.store_id)
 UNION ALL SELECT 'orphaned_product_ids', COUNT(*) FROM sales s WHERE NOT EXISTS (SELECT 1 FROM products p WHERE p.product_id = s.product_id)""")
def _(t):
    return inc.staging_checks(t.sales, t.stores, t.products, fail_on_issue=False)


@query("upsert_sales", "order_sales", f"WITH {SPLIT} {MERGED}")
def _(t):
    return inc.upsert(_as_target(_loaded(t)), _arriving(t), "transaction_id")


@query("watermark_update", "order_sales", f"""WITH {SPLIT} SELECT 'orders' AS table_name, MAX(date) AS last_loaded_date, MAX(transaction_id) AS last_loaded_id FROM staged""")
def _(t):
    mark = inc.initial_watermark(t.spark, "orders")
    return inc.watermark_update(_arriving(t), mark).drop("updated_at")


@query("refresh_log", "customer_sales", """SELECT 'summary_monthly_kpis' AS table_name, COUNT(DISTINCT date_trunc('month', date)) AS row_count FROM customer_sales
 UNION ALL SELECT 'summary_customer_segments', COUNT(DISTINCT customer_id) FROM customer_sales""")
def _(t):
    from shelfline.plans import summaries
    path = fresh_path(t.spark, "log")
    inc.append_log(inc.log_rows({"summary_monthly_kpis": summaries.summary_monthly_kpis(t.customer_sales)}), path)
    inc.append_log(inc.log_rows({"summary_customer_segments": summaries.summary_customer_segments(t.customer_sales)}), path)
    return inc.read_log(t.spark, path).select("table_name", "row_count")


@query("load_summary", "order_sales", """SELECT 'Incremental Load Complete' AS status, MAX(date) AS latest_date, COUNT(*) AS rows_loaded FROM order_sales
 WHERE transaction_id > 0""")
def _(t):
    return inc.run_incremental(t.spark, _with_year(t.order_sales), _paths(t), required=["transaction_id", "date"])


@query("incremental_load", "order_sales", f"WITH {SPLIT} {MERGED}")
def _(t):
    paths = _paths(t)
    inc.apply_batch(t.spark, _with_year(_as_target(_loaded(t))), paths, required=["transaction_id", "date"])
    inc.apply_batch(t.spark, _with_year(_arriving(t)), paths, required=["transaction_id", "date"])
    return versions.read(t.spark, paths.table).drop("sale_year")


@query("stream_incremental_load", "order_sales", f"""WITH {SPLIT} SELECT transaction_id, date, customer_id, CAST(quantity AS BIGINT) AS quantity,
  CAST(discount_percent AS BIGINT) AS discount_percent, CAST(total_amount AS DOUBLE) AS total_amount, status FROM staged
 UNION ALL SELECT transaction_id, date, customer_id, CAST(quantity AS BIGINT), CAST(discount_percent AS BIGINT), CAST(total_amount AS DOUBLE), status
  FROM old WHERE transaction_id NOT IN (SELECT transaction_id FROM staged)""")
def _(t):
    base, paths = fresh_path(t.spark, "stream"), _paths(t)
    for i, part in enumerate([_as_target(_loaded(t)), _arriving(t)]):
        rows = _with_year(part).withColumn("loaded_at", F.lit(f"2024-01-0{i + 1} 00:00:00").cast("timestamp"))
        rows.write.parquet(f"{base}/in/{i}")
    # Both deliveries are picked up by one run of the stream: changes meet the rows they change in one batch.
    source = stream.file_stream(t.spark, f"{base}/in/*", rows.schema)
    stream.stream_incremental_load(t.spark, source, paths, f"{base}/checkpoint", required=["transaction_id", "date"]).awaitTermination()
    out = versions.read(t.spark, paths.table).drop("sale_year")
    return out.select([c for c in t.order_sales.columns])


@query("stream_daily_sales", "daily", """SELECT date, CAST(store_id AS BIGINT) AS store_id, CAST(product_id AS BIGINT) AS product_id, CAST(daily_quantity AS BIGINT) AS daily_quantity,
  CAST(daily_revenue AS DOUBLE) AS daily_revenue, transaction_count, CAST(discounted_count AS BIGINT) AS discounted_count FROM daily""")
def _(t):
    base = fresh_path(t.spark, "stream")
    rows = t.series_sales.select("transaction_id", "store_id", "product_id", "quantity", "total_amount", "discount_applied",
                                 F.col("date").cast("timestamp").alias("event_time"))
    # A third of the rows of every day arrives in a file of its own, after all others.
    late = F.pmod(F.col("transaction_id"), F.lit(3)) == 0
    rows.where(~late).write.parquet(f"{base}/in/rows")
    rows.where(late).write.parquet(f"{base}/in/zz")
    source = stream.file_stream(t.spark, f"{base}/in/*", rows.schema, files_per_batch=1)
    stream.stream_daily_sales(source, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return stream.read_daily(t.spark, f"{base}/out")
