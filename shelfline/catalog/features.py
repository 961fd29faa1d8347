"""Calendar, promotions and forecast features."""

from pyspark.sql import functions as F

from shelfline.catalog.base import query
from shelfline.functions.calendar import calendar_dimension
from shelfline.operators import features as feat
from shelfline.operators.aggregates import daily_sales_agg
from shelfline.operators.promotions import promo_expand_days
from shelfline.sources.tables import write_features
from shelfline.session import fresh_path, materialize

KEY = "date, CAST(d.store_id AS BIGINT) AS store_id, CAST(d.product_id AS BIGINT) AS product_id"
DKEY = "d." + KEY
S = "PARTITION BY d.store_id, d.product_id ORDER BY d.date"


def daily(t):
    return daily_sales_agg(t.series_sales).select("date", "store_id", "product_id", "daily_quantity", "daily_revenue")


LAG_SQL = ",\n".join(
    [f"CAST(LAG(daily_revenue, {n}) OVER ({S}) AS DOUBLE) AS sales_lag_{n}" for n in (7, 14, 30)]
    + [f"CAST(LAG(daily_quantity, {n}) OVER ({S}) AS BIGINT) AS qty_lag_{n}" for n in (7, 14, 30)])


def _frame(n):
    return f"OVER ({S} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"


ROLL_SQL = ",\n".join(
    [f"CAST(SUM(daily_revenue) {_frame(n)} AS DOUBLE) / COUNT(daily_revenue) {_frame(n)} AS rolling_mean_{n}" for n in (7, 14, 30)]
    + [f"ROUND(STDDEV_SAMP(CAST(daily_revenue AS DOUBLE)) {_frame(n)}, 4) AS rolling_std_{n}" for n in (7, 14, 30)]
    + [f"CAST(MIN(daily_revenue) {_frame(7)} AS DOUBLE) AS rolling_min_7", f"CAST(MAX(daily_revenue) {_frame(7)} AS DOUBLE) AS rolling_max_7"])
STORE_FRAME = "OVER (PARTITION BY d.store_id ORDER BY d.product_id, d.date ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)"
PRODUCT_FRAME = "OVER (PARTITION BY d.product_id ORDER BY d.store_id, d.date ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)"
ENTITY_SQL = f"""CAST(SUM(daily_revenue) {STORE_FRAME} AS DOUBLE) / COUNT(daily_revenue) {STORE_FRAME} AS store_avg_daily_sales_30d,
 CAST(SUM(daily_revenue) {PRODUCT_FRAME} AS DOUBLE) / COUNT(daily_revenue) {PRODUCT_FRAME} AS product_avg_daily_sales_30d"""
CAL_SQL = "c.day_of_week, c.week_of_year, c.month, c.quarter, c.is_weekend, c.is_holiday, c.days_to_holiday, c.season"
STORE_SQL = "st.region AS store_region, st.store_format, CAST(st.size_sqft AS BIGINT) AS store_size_sqft"
PRODUCT_SQL = "p.category AS product_category, p.subcategory AS product_subcategory, CAST(p.unit_price AS DOUBLE) AS product_price, p.is_perishable"
WEATHER_SQL = """CAST(w.temp_high_f AS BIGINT) AS temp_high_f, CAST(w.temp_low_f AS BIGINT) AS temp_low_f,
 CAST(w.precipitation_inches AS DOUBLE) AS precipitation_inches, w.conditions AS weather_conditions"""
PROMO_CTE = """pd AS (SELECT CAST(x AS DATE) AS date, store_id, product_id, MAX(discount_percent) AS pct
  FROM (SELECT *, unnest(generate_series(start_date, end_date, INTERVAL 1 DAY)) AS x FROM series_promotions) GROUP BY 1, 2, 3)"""
PROMO_SQL = "pd.pct IS NOT NULL AS has_promotion, CAST(COALESCE(pd.pct, 0) AS BIGINT) AS promotion_discount"
PROMO_JOIN = "LEFT JOIN pd ON d.date = pd.date AND d.store_id = pd.store_id AND d.product_id = pd.product_id"


def rounded_std(df):
    return df.withColumns({f"rolling_std_{n}": F.round(f"rolling_std_{n}", 4) for n in (7, 14, 30)})


def keyed(df, *cols):
    return df.select("date", "store_id", "product_id", *cols)


@query("win_series_lag", "daily", f"SELECT {DKEY}, {LAG_SQL} FROM daily d")
@query("feat_lags", "daily", f"SELECT {DKEY}, {LAG_SQL} FROM daily d")
def lags(t):
    return feat.feat_lags(daily(t)).drop("daily_quantity", "daily_revenue")


@query("win_series_rolling", "daily", f"SELECT {DKEY}, {ROLL_SQL} FROM daily d")
@query("feat_rolling", "daily", f"SELECT {DKEY}, {ROLL_SQL} FROM daily d")
def rolling(t):
    return rounded_std(feat.feat_rolling(daily(t)).drop("daily_quantity", "daily_revenue"))


@query("win_entity_rolling", "daily", f"SELECT {DKEY}, {ENTITY_SQL} FROM daily d")
def _(t):
    return feat.feat_entity_avg(daily(t)).drop("daily_quantity", "daily_revenue")


@query("feat_entity_avg", "daily", f"SELECT {DKEY}, {ENTITY_SQL} FROM daily d")
def _(t):
    return feat.feat_entity_avg(daily(t)).drop("daily_quantity", "daily_revenue")


@query("feat_entity_day_avg", "daily", """WITH e AS (SELECT store_id, date, SUM(daily_revenue) AS s FROM daily GROUP BY 1, 2),
 a AS (SELECT store_id, date, CAST(SUM(s) OVER w AS DOUBLE) / COUNT(s) OVER w AS m FROM e
   WINDOW w AS (PARTITION BY store_id ORDER BY date RANGE BETWEEN INTERVAL 30 DAYS PRECEDING AND INTERVAL 1 DAYS PRECEDING))
 SELECT d.date, CAST(d.store_id AS BIGINT) AS store_id, CAST(d.product_id AS BIGINT) AS product_id, m AS store_avg_daily_sales_30d
 FROM daily d JOIN a ON d.store_id = a.store_id AND d.date = a.date""")
def _(t):
    return keyed(feat.feat_entity_avg(daily(t), by_day=True), "store_avg_daily_sales_30d")


@query("feat_calendar", "daily calendar", f"SELECT {DKEY}, {CAL_SQL} FROM daily d LEFT JOIN calendar c ON d.date = c.date")
def _(t):
    return feat.feat_calendar(keyed(daily(t)), t.calendar)


@query("feat_store", "daily series_stores", f"SELECT {KEY}, {STORE_SQL} FROM daily d LEFT JOIN series_stores st ON d.store_id = st.store_id")
def _(t):
    return feat.feat_store(keyed(daily(t)), t.series_stores)


@query("feat_product", "daily series_products", f"SELECT {KEY}, {PRODUCT_SQL} FROM daily d LEFT JOIN series_products p ON d.product_id = p.product_id")
def _(t):
    return feat.feat_product(keyed(daily(t)), t.series_products)


@query("feat_weather", "daily series_weather", f"SELECT {DKEY}, {WEATHER_SQL} FROM daily d LEFT JOIN series_weather w ON d.date = w.date AND d.store_id = w.store_id")
def _(t):
    return feat.feat_weather(keyed(daily(t)), t.series_weather)


@query("feat_promotion", "daily series_promotions", f"WITH {PROMO_CTE} SELECT {DKEY}, {PROMO_SQL} FROM daily d {PROMO_JOIN}")
def _(t):
    return feat.feat_promotion(keyed(daily(t)), t.series_promotions)


TABLE_CTES = f"""{PROMO_CTE}, x AS (SELECT d.date, d.store_id, d.product_id, CAST(daily_quantity AS BIGINT) AS daily_quantity,
   CAST(daily_revenue AS DOUBLE) AS daily_revenue_d, {LAG_SQL}, {ROLL_SQL}, {ENTITY_SQL} FROM daily d)"""
TABLE_SELECT = f"""SELECT d.date, CAST(d.store_id AS BIGINT) AS store_id, CAST(d.product_id AS BIGINT) AS product_id, daily_quantity, daily_revenue_d AS daily_revenue,
  d.* EXCLUDE (date, store_id, product_id, daily_quantity, daily_revenue_d), {CAL_SQL}, {STORE_SQL}, {PRODUCT_SQL}, {WEATHER_SQL}, {PROMO_SQL}
 FROM x d LEFT JOIN calendar c ON d.date = c.date LEFT JOIN series_stores st ON d.store_id = st.store_id
 LEFT JOIN series_products p ON d.product_id = p.product_id LEFT JOIN series_weather w ON d.date = w.date AND d.store_id = w.store_id
 {PROMO_JOIN} WHERE sales_lag_7 IS NOT NULL"""
TABLE_SQL = f"WITH {TABLE_CTES} {TABLE_SELECT}"
TABLE_VIEWS = "daily calendar series_stores series_products series_weather series_promotions"


def feature_table(t):
    # The daily rows are stored once; the calendar's span and the weather's keys are read off them.
    rows = materialize(daily(t), "daily")
    span = rows.agg(F.min("date").alias("start_date"), F.max("date").alias("end_date"))
    weather = t._weather(rows.select("date", "store_id").distinct())
    return feat.feat_table(rows, calendar_dimension(span), t.series_stores, t.series_products, weather, t.series_promotions)


@query("feat_table", TABLE_VIEWS, TABLE_SQL)
def _(t):
    return rounded_std(feature_table(t))


@query("write_features", TABLE_VIEWS, TABLE_SQL)
def _(t):
    path = fresh_path(t.spark, "features")
    write_features(rounded_std(feature_table(t)), path)
    return t.spark.read.parquet(path).drop("feature_month")


@query("calendar_dimension", "calendar", """SELECT date, year, month, day, day_of_week, day_name, week_of_year, quarter, fiscal_quarter, is_weekend,
 is_holiday, holiday_name, is_month_start, is_month_end, days_to_holiday, season FROM calendar""")
def _(t):
    return calendar_dimension(t.date_bounds)


@query("promo_expand_days", "promotions", """SELECT store_id, product_id, CAST(discount_percent AS BIGINT) AS discount_percent,
 CAST(unnest(generate_series(start_date, end_date, INTERVAL 1 DAY)) AS DATE) AS date FROM promotions""")
def _(t):
    return promo_expand_days(t.promotions)
