"""Declared schemas of the retail tables; files are never read with inferred types."""

from __future__ import annotations

STORES = """store_id INT, store_name STRING, region STRING, store_format STRING, size_sqft INT,
    open_date DATE, latitude DECIMAL(10,6), longitude DECIMAL(10,6), manager_count INT, employee_count INT"""
PRODUCTS = """product_id INT, product_name STRING, category STRING, subcategory STRING, brand STRING,
    unit_price DECIMAL(10,2), unit_cost DECIMAL(10,2), weight_kg DECIMAL(8,2), is_perishable BOOLEAN,
    shelf_life_days INT"""
CALENDAR = """date DATE, year INT, month INT, day INT, day_of_week INT, day_name STRING, week_of_year INT,
    quarter INT, fiscal_quarter INT, is_weekend BOOLEAN, is_holiday BOOLEAN, holiday_name STRING,
    is_month_start BOOLEAN, is_month_end BOOLEAN, days_to_holiday INT, season STRING"""
PROMOTIONS = """promotion_id BIGINT, store_id INT, product_id INT, promotion_type STRING,
    discount_percent INT, start_date DATE, end_date DATE, is_featured BOOLEAN"""
SALES = """transaction_id BIGINT, date DATE, store_id INT, product_id INT, customer_id INT, quantity INT,
    unit_price DECIMAL(10,2), discount_applied BOOLEAN, discount_percent INT, total_amount DECIMAL(12,2)"""
WEATHER = """weather_id BIGINT, date DATE, store_id INT, temp_high_f INT, temp_low_f INT,
    precipitation_inches DECIMAL(5,2), humidity_percent INT, wind_speed_mph DECIMAL(5,1), conditions STRING"""
CUSTOMERS = """customer_id INT, segment STRING, first_purchase_date DATE, lifetime_value DECIMAL(12,2),
    purchase_frequency_monthly DECIMAL(5,1), avg_basket_size DECIMAL(10,2), age_group STRING,
    preferred_channel STRING, email_opt_in BOOLEAN"""
FORECASTS = """forecast_date DATE, target_date DATE, store_id INT, product_id INT, horizon_days INT,
    predicted_quantity DOUBLE, predicted_revenue DOUBLE, lower_bound DOUBLE, upper_bound DOUBLE,
    model_name STRING, model_version STRING, actual_quantity BIGINT, actual_revenue DECIMAL(22,4),
    absolute_error DOUBLE, percentage_error DOUBLE"""
STAGING_SALES = SALES + ", loaded_at TIMESTAMP"
WATERMARKS = "table_name STRING, last_loaded_date DATE, last_loaded_id BIGINT, updated_at TIMESTAMP"
REFRESH_LOG = "refresh_id STRING, table_name STRING, refresh_timestamp TIMESTAMP, row_count BIGINT"

TABLES = {
    "stores": STORES, "products": PRODUCTS, "calendar": CALENDAR, "customers": CUSTOMERS,
    "weather": WEATHER, "promotions": PROMOTIONS, "sales_transactions": SALES,
}
# Dimensions are loaded before the fact.
DIMENSIONS = ["stores", "products", "calendar", "customers", "weather", "promotions"]
