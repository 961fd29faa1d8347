"""Registry that pairs each named query with the SQL an independent engine runs for comparison."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.sources.driver_tables import DriverTables


@dataclass(frozen=True)
class Entry:
    run: Callable[[DriverTables], DataFrame]
    sql: str | None


REGISTRY: dict[str, Entry] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Uniform result types: integers as BIGINT, exact decimals as DOUBLE."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType) or isinstance(f.dataType, T.FloatType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        out.append(c.alias(f.name))
    return df.select(*out)


def query(name: str, views: str = "", sql: str | None = None):
    """Register a query; ``views`` names the retail views its SQL refers to."""
    def register(fn: Callable[[DriverTables], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"query {name} registered twice")
        REGISTRY[name] = Entry(fn, with_views(views, sql) if sql else None)
        return fn
    return register


def with_views(views: str, body: str) -> str:
    """Put the view definitions in front of a statement that may have its own WITH list."""
    needed: list[str] = []

    def need(name: str) -> None:
        for dep in VIEWS[name][0].split():
            need(dep)
        if name not in needed:
            needed.append(name)

    for v in views.split():
        need(v)
    ctes = [f"{v} AS ({VIEWS[v][1]})" for v in needed]
    body = body.strip()
    if not ctes:
        return body
    for start in ("WITH RECURSIVE ", "WITH "):
        if body.upper().startswith(start):
            return start + ",\n".join(ctes) + ",\n" + body[len(start):]
    return "WITH " + ",\n".join(ctes) + "\n" + body


_AMOUNT = """CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(100 - CAST(ROUND(l_discount * 100) AS INTEGER) AS DECIMAL(3,0))
        * CAST(0.01 AS DECIMAL(3,2))"""
_FACT = f"""CAST(l_shipdate AS DATE) AS date, CAST(l_quantity AS INTEGER) AS quantity,
        l_extendedprice / l_quantity AS unit_price, l_discount > 0 AS discount_applied,
        CAST(ROUND(l_discount * 100) AS INTEGER) AS discount_percent, {_AMOUNT} AS total_amount"""
_FORMAT = "CASE {0} % 4 WHEN 0 THEN 'Supermarket' WHEN 1 THEN 'Hypermarket' WHEN 2 THEN 'Express' ELSE 'Online' END"


def _weather(sales: str) -> str:
    return f"""SELECT date, store_id, temp_high_f, temp_high_f - 5 - (d + s * 3) % 20 AS temp_low_f,
        CAST(CASE WHEN wet < 60 THEN 0 ELSE wet - 59 END * CAST(0.05 AS DECIMAL(3,2)) AS DECIMAL(5,2)) AS precipitation_inches,
        humidity_percent,
        ['Clear', 'Cloudy', 'Fog', 'Hot', 'Rain', 'Snow', 'Storm', 'Windy'][(d * 5 + s * 3) % 8 + 1] AS conditions
      FROM (SELECT date, store_id, d, s, (d * 11 + s * 5) % 100 AS wet, 20 + (d * 7 + s * 13) % 80 AS temp_high_f,
              30 + (d * 3 + s * 17) % 65 AS humidity_percent
            FROM (SELECT DISTINCT date, store_id, date - DATE '1995-01-01' AS d, store_id AS s FROM {sales}))"""


def _promotions(sales: str, least: int) -> str:
    return f"""SELECT store_id, product_id, MAX(discount_percent) AS discount_percent, date AS start_date,
        date + CAST(product_id % 14 AS INTEGER) AS end_date
      FROM {sales} WHERE discount_percent >= {least} GROUP BY store_id, product_id, date"""


# name -> (views it builds on, definition); mirrors sources/driver_tables.py
VIEWS = {
    "sales": ("", f"""SELECT l_orderkey AS transaction_id, l_suppkey AS store_id, l_partkey AS product_id, {_FACT}
        FROM lineitem"""),
    "customer_sales": ("", f"""SELECT l_orderkey AS transaction_id, l_suppkey AS store_id, l_partkey AS product_id,
        CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey END AS customer_id, {_FACT}
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""),
    "order_sales": ("", """SELECT o_orderkey AS transaction_id, CAST(o_orderdate AS DATE) AS date,
        o_custkey AS customer_id, CAST(o_orderkey % 50 + 1 AS INTEGER) AS quantity,
        CAST(o_custkey % 11 AS INTEGER) AS discount_percent,
        CAST(o_totalprice AS DECIMAL(12,2)) AS total_amount, o_orderstatus AS status FROM orders"""),
    "stores": ("", f"""SELECT s_suppkey AS store_id, s_name AS store_name, r_name AS region,
        {_FORMAT.format('s_suppkey')} AS store_format,
        CAST(5000 + (s_suppkey * 7919) % 145000 AS INTEGER) AS size_sqft,
        DATE '1990-01-01' + CAST((s_suppkey * 37) % 1800 AS INTEGER) AS open_date
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""),
    "products": ("", """SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
        p_brand AS subcategory, CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price,
        CAST(p_retailprice AS DECIMAL(10,2)) * CAST(0.60 AS DECIMAL(3,2)) AS unit_cost,
        p_size <= 12 AS is_perishable FROM part"""),
    "customers": ("", """SELECT c_custkey AS customer_id, c_mktsegment AS segment,
        CAST(c_acctbal AS DECIMAL(12,2)) AS lifetime_value FROM customer"""),
    "calendar": ("", """SELECT date, year(date) AS year, month(date) AS month, day(date) AS day,
        isodow(date) - 1 AS day_of_week, dayname(date) AS day_name, week(date) AS week_of_year,
        quarter(date) AS quarter, quarter(date) AS fiscal_quarter, isodow(date) >= 6 AS is_weekend,
        holiday IS NOT NULL AS is_holiday, holiday AS holiday_name, day(date) = 1 AS is_month_start,
        day(date + 1) = 1 AS is_month_end,
        LEAST(365,
          CASE WHEN make_date(year(date), 12, 25) > date THEN make_date(year(date), 12, 25) ELSE make_date(year(date) + 1, 12, 25) END - date,
          CASE WHEN make_date(year(date), 11, 27) > date THEN make_date(year(date), 11, 27) ELSE make_date(year(date) + 1, 11, 27) END - date,
          CASE WHEN make_date(year(date), 7, 4) > date THEN make_date(year(date), 7, 4) ELSE make_date(year(date) + 1, 7, 4) END - date,
          make_date(year(date) + 1, 1, 1) - date) AS days_to_holiday,
        CASE month(date) % 12 // 3 WHEN 0 THEN 'Winter' WHEN 1 THEN 'Spring' WHEN 2 THEN 'Summer' ELSE 'Fall' END AS season
      FROM (SELECT date, CASE
          WHEN month(date) = 1 AND day(date) = 1 THEN 'New Year''s Day'
          WHEN month(date) = 7 AND day(date) = 4 THEN 'Independence Day'
          WHEN month(date) = 11 AND day(date) = 11 THEN 'Veterans Day'
          WHEN month(date) = 12 AND day(date) = 25 THEN 'Christmas Day'
          WHEN month(date) = 12 AND day(date) = 31 THEN 'New Year''s Eve'
          WHEN month(date) = 1 AND isodow(date) = 1 AND day(date) BETWEEN 15 AND 21 THEN 'Martin Luther King Jr. Day'
          WHEN month(date) = 2 AND isodow(date) = 1 AND day(date) BETWEEN 15 AND 21 THEN 'Presidents'' Day'
          WHEN month(date) = 5 AND isodow(date) = 1 AND day(date) > 24 THEN 'Memorial Day'
          WHEN month(date) = 9 AND isodow(date) = 1 AND day(date) <= 7 THEN 'Labor Day'
          WHEN month(date) = 10 AND isodow(date) = 1 AND day(date) BETWEEN 8 AND 14 THEN 'Columbus Day'
          WHEN month(date) = 11 AND isodow(date) = 4 AND day(date) BETWEEN 22 AND 28 THEN 'Thanksgiving'
          WHEN month(date) = 11 AND isodow(date) = 5 AND day(date) BETWEEN 23 AND 29 THEN 'Black Friday'
        END AS holiday
        FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date
              FROM (SELECT MIN(CAST(l_shipdate AS DATE)) AS lo, MAX(CAST(l_shipdate AS DATE)) AS hi FROM lineitem)))"""),
    "weather": ("sales", _weather("sales")),
    "promotions": ("sales", _promotions("sales", 8)),
    "series_sales": ("", f"""SELECT l_orderkey AS transaction_id, n_regionkey AS store_id,
        CAST(split_part(p_brand, '#', 2) AS INTEGER) AS product_id, {_FACT}
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
        JOIN part ON l_partkey = p_partkey"""),
    "series_stores": ("", f"""SELECT r_regionkey AS store_id, r_name AS region, {_FORMAT.format('r_regionkey')} AS store_format,
        20000 + r_regionkey * 7919 AS size_sqft FROM region"""),
    "series_products": ("", """SELECT CAST(split_part(p_brand, '#', 2) AS INTEGER) AS product_id, MIN(p_type) AS category,
        MIN(p_brand) AS subcategory, CAST(MIN(p_retailprice) AS DECIMAL(10,2)) AS unit_price,
        MIN(p_size) <= 1 AS is_perishable FROM part GROUP BY 1"""),
    "series_weather": ("series_sales", _weather("series_sales")),
    "series_promotions": ("series_sales", _promotions("series_sales", 10)),
    "daily": ("series_sales", """SELECT date, store_id, product_id, SUM(quantity) AS daily_quantity,
        SUM(total_amount) AS daily_revenue, COUNT(transaction_id) AS transaction_count,
        SUM(CASE WHEN discount_applied THEN 1 ELSE 0 END) AS discounted_count
        FROM series_sales GROUP BY date, store_id, product_id"""),
}
