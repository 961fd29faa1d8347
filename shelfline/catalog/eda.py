"""Exploratory analyses."""

from shelfline.catalog.base import query
from shelfline.plans import eda

DAYS = """d AS (SELECT date, SUM(total_amount) AS rev, CAST(SUM(quantity) AS BIGINT) AS units, COUNT(transaction_id) AS n FROM sales GROUP BY date)"""


@query("eda_daily_trend", "sales", f"""WITH {DAYS} SELECT date, CAST(rev AS DOUBLE) AS revenue, units, n AS num_transactions, year(date) AS year, month(date) AS month,
 isodow(date) - 1 AS day_of_week FROM d""")
def _(t):
    return eda.eda_daily_trend(t.sales)


@query("eda_daily_summary", "sales", f"""WITH {DAYS} SELECT CAST(SUM(rev) AS DOUBLE) AS total_revenue, CAST(SUM(rev) AS DOUBLE) / COUNT(rev) AS avg_daily_revenue,
 CAST(MAX(rev) AS DOUBLE) AS max_daily_revenue, CAST(MIN(rev) AS DOUBLE) AS min_daily_revenue FROM d""")
def _(t):
    return eda.eda_daily_summary(t.sales)


@query("eda_monthly_resample", "sales", """WITH m AS (SELECT CAST(date_trunc('month', date) AS DATE) AS month_start, SUM(total_amount) AS rev, CAST(SUM(quantity) AS BIGINT) AS units,
   COUNT(*) AS n FROM sales GROUP BY 1),
 s AS (SELECT CAST(unnest(generate_series((SELECT MIN(month_start) FROM m), (SELECT MAX(month_start) FROM m), INTERVAL 1 MONTH)) AS DATE) AS month_start)
 SELECT s.month_start, CAST(COALESCE(rev, 0) AS DOUBLE) AS revenue, COALESCE(units, 0) AS units, COALESCE(n, 0) AS num_transactions FROM s LEFT JOIN m ON s.month_start = m.month_start""")
def _(t):
    return eda.eda_monthly_resample(t.sales)


@query("eda_month_pattern", "sales", f"""WITH {DAYS}, m AS (SELECT month(date) AS month, CAST(SUM(rev) AS DOUBLE) / COUNT(*) AS a FROM d GROUP BY 1)
 SELECT r.range AS month, COALESCE(a, 0) AS avg_daily_revenue FROM range(1, 13) r LEFT JOIN m ON r.range = m.month""")
def _(t):
    return eda.eda_month_pattern(t.sales)


DOW = f"{DAYS}, w AS (SELECT isodow(date) - 1 AS day_of_week, CAST(SUM(rev) AS DOUBLE) / COUNT(*) AS a FROM d GROUP BY 1)"


@query("eda_dow_pattern", "sales", f"WITH {DOW} SELECT day_of_week, a AS avg_daily_revenue FROM w")
def _(t):
    return eda.eda_dow_pattern(t.sales)


@query("eda_dow_summary", "sales", f"""WITH {DOW}, r AS (SELECT day_of_week, CAST(ROUND(a, 6) AS DECIMAL(30,6)) AS r FROM w)
 SELECT (CAST(SUM(r) FILTER (day_of_week >= 5) AS DOUBLE) / COUNT(*) FILTER (day_of_week >= 5)) / (CAST(SUM(r) FILTER (day_of_week < 5) AS DOUBLE) / COUNT(*) FILTER (day_of_week < 5)) AS weekend_ratio,
 max_by(day_of_week, r) AS best_day, min_by(day_of_week, r) AS worst_day FROM r""")
def _(t):
    return eda.eda_dow_summary(t.sales)


@query("eda_holiday_lift", "sales calendar", """WITH g AS (SELECT is_holiday, CAST(SUM(total_amount) AS DOUBLE) / COUNT(total_amount) AS a, CAST(SUM(total_amount) AS DOUBLE) AS s, COUNT(total_amount) AS n
  FROM sales LEFT JOIN calendar ON sales.date = calendar.date GROUP BY is_holiday)
 SELECT is_holiday, a AS avg_transaction, s AS total_sales, n AS num_transactions,
  ROUND(((SELECT a FROM g WHERE is_holiday) / (SELECT a FROM g WHERE NOT is_holiday) - 1) * 100, 4) AS holiday_lift_pct FROM g""")
def _(t):
    return eda.eda_holiday_lift(t.sales, t.calendar)


STORE = """s AS (SELECT st.store_id, st.region, st.store_format, st.size_sqft, SUM(total_amount) AS rev, CAST(SUM(quantity) AS BIGINT) AS units, COUNT(*) AS n
 FROM sales sa JOIN stores st ON sa.store_id = st.store_id GROUP BY 1, 2, 3, 4)"""


@query("eda_store_perf", "sales stores", f"""WITH {STORE} SELECT 'region' AS level, region AS name, COUNT(*) AS stores, CAST(SUM(rev) AS DOUBLE) AS revenue, CAST(SUM(units) AS BIGINT) AS units,
  CAST(SUM(n) AS BIGINT) AS num_transactions FROM s GROUP BY region
 UNION ALL SELECT 'store_format', store_format, COUNT(*), CAST(SUM(rev) AS DOUBLE), CAST(SUM(units) AS BIGINT), CAST(SUM(n) AS BIGINT) FROM s GROUP BY store_format""")
def _(t):
    return eda.eda_store_perf(t.sales, t.stores)


@query("eda_store_size_trend", "sales stores", f"""WITH {STORE} SELECT ROUND(corr(CAST(size_sqft AS DOUBLE), CAST(rev AS DOUBLE)), 6) AS size_sales_corr,
 ROUND(regr_slope(CAST(rev AS DOUBLE), CAST(size_sqft AS DOUBLE)), 6) AS slope, ROUND(regr_intercept(CAST(rev AS DOUBLE), CAST(size_sqft AS DOUBLE)), 2) AS intercept FROM s""")
def _(t):
    return eda.eda_store_size_trend(t.sales, t.stores)


@query("eda_category", "sales products", """SELECT category, CAST(SUM(total_amount) AS DOUBLE) AS revenue, CAST(SUM(quantity) AS BIGINT) AS units, COUNT(DISTINCT p.product_id) AS products
 FROM sales s JOIN products p ON s.product_id = p.product_id GROUP BY category""")
def _(t):
    return eda.eda_category(t.sales, t.products)


@query("eda_perishable_split", "sales products", """WITH g AS (SELECT is_perishable, SUM(total_amount) AS r FROM sales s JOIN products p ON s.product_id = p.product_id GROUP BY 1)
 SELECT is_perishable, CAST(r AS DOUBLE) AS revenue, ROUND(CAST(r AS DOUBLE) / CAST(SUM(r) OVER () AS DOUBLE) * 100, 2) AS share_pct FROM g""")
def _(t):
    return eda.eda_perishable_split(t.sales, t.products)


@query("eda_price_histogram", "products", """WITH b AS (SELECT CAST(MIN(unit_price) AS DOUBLE) AS lo, CAST(MAX(unit_price) AS DOUBLE) AS hi FROM products)
 SELECT LEAST(CAST(FLOOR((CAST(unit_price AS DOUBLE) - lo) / (hi - lo) * 50) AS BIGINT) + 1, 50) AS bin, COUNT(*) AS row_count,
  CAST(MIN(unit_price) AS DOUBLE) AS lowest, CAST(MAX(unit_price) AS DOUBLE) AS highest FROM products, b GROUP BY 1""")
def _(t):
    return eda.eda_price_histogram(t.products)


@query("eda_price_summary", "products", """SELECT CAST(SUM(unit_price) AS DOUBLE) / COUNT(*) AS mean_price,
 ROUND(PERCENTILE_CONT(0.5) WITHIN GROUP (ORDER BY CAST(unit_price AS DOUBLE)), 4) AS median_price FROM products""")
def _(t):
    return eda.eda_price_summary(t.products)


@query("eda_weather_impact", "sales weather", """SELECT conditions, ROUND(CAST(SUM(total_amount) AS DOUBLE) / COUNT(*), 2) AS avg_transaction, CAST(SUM(total_amount) AS DOUBLE) AS total_sales,
 COUNT(*) AS num_transactions FROM sales s LEFT JOIN weather w ON s.date = w.date AND s.store_id = w.store_id GROUP BY conditions""")
def _(t):
    return eda.eda_weather_impact(t.sales, t.weather)


@query("eda_temperature_corr", "sales weather", """SELECT ROUND(corr(CAST(temp_high_f AS DOUBLE), CAST(total_amount AS DOUBLE)), 6) AS temp_sales_corr
 FROM sales s LEFT JOIN weather w ON s.date = w.date AND s.store_id = w.store_id""")
def _(t):
    return eda.eda_temperature_corr(t.sales, t.weather)


@query("eda_promo_lift", "sales", """WITH g AS (SELECT discount_applied, CAST(SUM(total_amount) AS DOUBLE) / COUNT(*) AS a, SUM(total_amount) AS s, COUNT(*) AS n,
  CAST(SUM(quantity) AS DOUBLE) / COUNT(*) AS q FROM sales GROUP BY 1)
 SELECT discount_applied, a AS avg_amount, CAST(s AS DOUBLE) AS total_amount, n AS transactions, q AS avg_quantity,
  ROUND(((SELECT q FROM g WHERE discount_applied) / (SELECT q FROM g WHERE NOT discount_applied) - 1) * 100, 4) AS quantity_lift_pct FROM g""")
def _(t):
    return eda.eda_promo_lift(t.sales)


@query("eda_segments", "customers", """WITH g AS (SELECT segment, COUNT(*) AS n, CAST(SUM(lifetime_value) AS DOUBLE) / COUNT(lifetime_value) AS a FROM customers GROUP BY 1)
 SELECT segment, n AS customers, a AS avg_lifetime_value, ROUND(CAST(n AS DOUBLE) / CAST(SUM(n) OVER () AS DOUBLE) * 100, 1) AS share_pct FROM g""")
def _(t):
    return eda.eda_segments(t.customers)


def _corr_sql(columns, frame, a="column_a", b="column_b"):
    from itertools import combinations
    rows = [f"SELECT '{x}' AS {a}, '{y}' AS {b}, ROUND(corr(CAST(\"{x}\" AS DOUBLE), CAST(\"{y}\" AS DOUBLE)), 6) AS correlation FROM {frame}"
            for x, y in combinations(columns, 2)]
    return " UNION ALL ".join(rows)


CORR_FRAME = """f AS (SELECT d.date, d.store_id, rev AS total_amount, units AS quantity, temp_high_f, temp_low_f, precipitation_inches, humidity_percent,
  day_of_week, CAST(is_weekend AS INTEGER) AS is_weekend, CAST(is_holiday AS INTEGER) AS is_holiday, week_of_year, month
 FROM (SELECT date, store_id, SUM(total_amount) AS rev, SUM(quantity) AS units FROM sales GROUP BY 1, 2) d
 LEFT JOIN weather w ON d.date = w.date AND d.store_id = w.store_id LEFT JOIN calendar c ON d.date = c.date)"""


@query("eda_correlation_matrix", "sales weather calendar", f"WITH {CORR_FRAME} {_corr_sql(eda.CORRELATED, 'f')}")
def _(t):
    return eda.eda_correlation_matrix(eda.correlation_frame(t.sales, t.weather, t.calendar))


@query("eda_target_correlation", "sales weather calendar", f"""WITH {CORR_FRAME}, m AS ({_corr_sql(eda.CORRELATED, 'f')})
 SELECT column_b AS feature, abs(correlation) AS abs_correlation FROM m WHERE column_a = 'total_amount'""")
def _(t):
    return eda.target_correlations(eda.eda_correlation_matrix(eda.correlation_frame(t.sales, t.weather, t.calendar)))


TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@query("insight_copurchase", "customer_sales products", "WITH f AS (SELECT customer_id, " + ", ".join(
    f"COALESCE(SUM(total_amount) FILTER (category = '{c}'), 0) AS \"{c}\"" for c in TYPES) + """
  FROM customer_sales s JOIN products p ON s.product_id = p.product_id WHERE customer_id IS NOT NULL GROUP BY 1) """ + _corr_sql(TYPES, "f", "category_a", "category_b"))
def _(t):
    return eda.insight_copurchase(t.customer_sales, t.products)


@query("insight_early_buyers", "customer_sales", """WITH d AS (SELECT customer_id, date, COUNT(DISTINCT transaction_id) AS n, SUM(total_amount) AS s FROM customer_sales WHERE customer_id IS NOT NULL GROUP BY 1, 2),
 f AS (SELECT customer_id, MIN(date) AS first FROM d GROUP BY 1),
 p AS (SELECT d.customer_id, COALESCE(SUM(n) FILTER (date - first < 60), 0) >= 3 AS e, SUM(s) AS ltv FROM d JOIN f ON d.customer_id = f.customer_id GROUP BY 1),
 g AS (SELECT e, COUNT(*) AS c, CAST(SUM(ltv) AS DOUBLE) / COUNT(*) AS a FROM p GROUP BY e)
 SELECT e AS is_early_buyer, c AS customers, a AS avg_ltv, ROUND(((SELECT a FROM g WHERE e) / (SELECT a FROM g WHERE NOT e) - 1) * 100, 4) AS ltv_lift_pct FROM g""")
def _(t):
    return eda.insight_early_buyers(t.customer_sales)


@query("insight_lag_autocorr", "sales", f"""WITH {DAYS}, l AS (SELECT CAST(rev AS DOUBLE) AS x, LAG(CAST(rev AS DOUBLE), 7) OVER (ORDER BY date) AS l7, LAG(CAST(rev AS DOUBLE), 30) OVER (ORDER BY date) AS l30 FROM d)
 SELECT 'lag_7' AS lag, ROUND(corr(x, l7), 6) AS autocorrelation FROM l UNION ALL SELECT 'lag_30', ROUND(corr(x, l30), 6) FROM l""")
def _(t):
    return eda.insight_lag_autocorr(t.sales)


@query("insight_region_growth", "sales stores", """WITH y AS (SELECT st.region, st.store_id, year(date) AS year, SUM(total_amount) AS rev FROM sales s JOIN stores st ON s.store_id = st.store_id GROUP BY 1, 2, 3),
 r AS (SELECT region, year, COUNT(*) AS stores, SUM(rev) AS rev, ROUND(STDDEV_SAMP(CAST(rev AS DOUBLE)), 2) AS sd FROM y GROUP BY 1, 2),
 p AS (SELECT *, LAG(rev) OVER (PARTITION BY region ORDER BY year) AS prev FROM r)
 SELECT region, year, stores, CAST(rev AS DOUBLE) AS revenue, CAST(rev AS DOUBLE) / stores AS revenue_per_store, sd AS store_std_dev,
  CASE WHEN prev > 0 THEN ROUND(CAST(rev - prev AS DOUBLE) / CAST(prev AS DOUBLE) * 100, 2) END AS yoy_growth_pct FROM p""")
def _(t):
    return eda.insight_region_growth(t.sales, t.stores)


@query("insight_format_density", "sales stores", f"WITH {STORE} SELECT store_format, CAST(SUM(rev) AS DOUBLE) AS revenue, CAST(SUM(rev) AS DOUBLE) / CAST(SUM(size_sqft) AS DOUBLE) AS revenue_per_sqft FROM s GROUP BY 1")
def _(t):
    return eda.insight_format_density(t.sales, t.stores)


@query("insight_weather_category", "sales products weather", """WITH b AS (SELECT CASE WHEN a < 32 THEN 'Freezing (<32°F)' WHEN a < 50 THEN 'Cold (32-50°F)' WHEN a < 70 THEN 'Mild (50-70°F)'
   WHEN a < 85 THEN 'Warm (70-85°F)' ELSE 'Hot (>85°F)' END AS band, category, SUM(total_amount) AS rev
  FROM sales s JOIN products p ON s.product_id = p.product_id JOIN (SELECT date, store_id, (temp_high_f + temp_low_f) // 2 AS a FROM weather) w
   ON s.date = w.date AND s.store_id = w.store_id GROUP BY 1, 2)
 SELECT band AS temperature_band, max_by(category, rev) AS best_category, CAST(MAX(rev) AS DOUBLE) AS best_revenue, min_by(category, rev) AS worst_category,
  CAST(MIN(rev) AS DOUBLE) AS worst_revenue FROM b GROUP BY band""")
def _(t):
    return eda.insight_weather_category(t.sales, t.products, t.weather)


@query("insight_rain_effect", "sales weather", """WITH d AS (SELECT date, store_id, COUNT(DISTINCT transaction_id) AS v, SUM(total_amount) AS s FROM sales GROUP BY 1, 2),
 g AS (SELECT precipitation_inches <> 0 AS r, COUNT(*) AS n, CAST(SUM(v) AS DOUBLE) / COUNT(*) AS av, CAST(SUM(s) AS DOUBLE) / CAST(SUM(v) AS DOUBLE) AS ab
   FROM d JOIN weather w ON d.date = w.date AND d.store_id = w.store_id GROUP BY 1)
 SELECT r AS is_rainy, n AS store_days, av AS avg_visits, ab AS avg_basket,
  ROUND(((SELECT av FROM g WHERE r) / (SELECT av FROM g WHERE NOT r) - 1) * 100, 4) AS visit_lift_pct,
  ROUND(((SELECT ab FROM g WHERE r) / (SELECT ab FROM g WHERE NOT r) - 1) * 100, 4) AS basket_lift_pct FROM g""")
def _(t):
    return eda.insight_rain_effect(t.sales, t.weather)
