"""Calendar, promotions and series features."""

import datetime as dt

import pytest
from retail_rows import day, money, sale
from pyspark.sql import functions as F

from shelfline.functions.calendar import calendar_between
from shelfline.operators import features as feat
from shelfline.operators import promotions as promo


def test_calendar_january(spark):
    rows = {r.date: r for r in calendar_between(spark, "2024-01-01", "2024-01-31").collect()}
    assert len(rows) == 31
    assert sum(rows[day(f"2024-01-{d:02d}")].is_weekend for d in range(1, 8)) == 2
    first = rows[day("2024-01-01")]
    assert (first.day_of_week, first.holiday_name, first.is_month_start, first.season) == (0, "New Year's Day", True, "Winter")
    assert rows[day("2024-01-15")].holiday_name == "Martin Luther King Jr. Day"


def test_calendar_against_plain_rules(spark):
    rows = {r.date: r for r in calendar_between(spark, "1999-01-01", "2006-12-31").collect()}
    for d, r in rows.items():
        assert r.week_of_year == d.isocalendar()[1] and r.day_name == d.strftime("%A")
        assert r.is_month_end == ((d + dt.timedelta(days=1)).day == 1)
        nexts = [x for y in (d.year, d.year + 1) for x in (dt.date(y, 12, 25), dt.date(y, 11, 27), dt.date(y, 7, 4), dt.date(y, 1, 1)) if x > d]
        assert r.days_to_holiday == min((x - d).days for x in nexts)
    named = {d: r.holiday_name for d, r in rows.items() if r.is_holiday}
    assert len(named) == 8 * 12
    assert named[day("2004-11-25")] == "Thanksgiving" and named[day("2004-11-26")] == "Black Friday"
    assert named[day("2004-05-31")] == "Memorial Day" and named[day("2003-09-01")] == "Labor Day"


def test_empty_calendar(spark):
    assert calendar_between(spark, "2024-02-01", "2024-01-01").count() == 0


@pytest.fixture(scope="module")
def promotions(spark):
    rows = [(1, 1, 10, day("2024-01-01"), day("2024-01-05")), (1, 1, 25, day("2024-01-04"), day("2024-01-06")),
            (1, 2, 30, day("2024-01-10"), day("2024-01-01")), (2, 1, 15, day("2023-01-01"), day("2024-12-31"))]
    return spark.createDataFrame(rows, "store_id INT, product_id INT, discount_percent INT, start_date DATE, end_date DATE")


def test_promotion_days(promotions):
    days = promo.promo_expand_days(promotions.where("store_id = 1"))
    assert days.count() == 5 + 3  # the reversed range has no day
    best = {str(r.date): r.promotion_discount for r in promo.promo_days(promotions).where("store_id = 1").collect()}
    assert best == {"2024-01-01": 10, "2024-01-02": 10, "2024-01-03": 10, "2024-01-04": 25, "2024-01-05": 25, "2024-01-06": 25}


def test_promotion_price_takes_largest_discount(spark, promotions):
    rows = [(1, day("2024-01-02"), 1, 1, 3, money("9.99")), (2, day("2024-01-05"), 1, 1, 1, money("9.99")),
            (3, day("2024-01-05"), 1, 2, 1, money("9.99")), (4, day("2024-06-01"), 2, 1, 2, money("10.00"))]
    sales = spark.createDataFrame(rows, "transaction_id INT, date DATE, store_id INT, product_id INT, quantity INT, base_price DECIMAL(10,2)")
    got = {r.transaction_id: r for r in promo.promo_effective_price(sales, promotions).collect()}
    assert [str(got[i].unit_price) for i in (1, 2, 3, 4)] == ["8.99", "7.49", "9.99", "8.50"]
    assert (got[1].total_amount, got[1].discount_percent, got[3].discount_applied) == (money("26.97"), 10, False)
    flags = {r.transaction_id: r.in_promotion for r in promo.promo_range_join(sales, promotions).collect()}
    assert flags == {1: True, 2: True, 3: False, 4: True}  # the last one is matched by day blocks


def series(spark, n, store=1, product=1, start="2024-01-01"):
    rows = [(day(start) + dt.timedelta(days=i * 2), store, product, i + 1, money(f"{(i + 1) * 10}.00")) for i in range(n)]
    return spark.createDataFrame(rows, "date DATE, store_id INT, product_id INT, daily_quantity BIGINT, daily_revenue DECIMAL(12,2)")


@pytest.mark.parametrize("n,kept", [(1, 0), (7, 0), (8, 1), (31, 24)])
def test_series_edges(spark, stores, products, n, kept):
    calendar = calendar_between(spark, "2024-01-01", "2024-01-30")
    table = feat.feat_table(series(spark, n), calendar, stores, products)
    rows = {r.daily_quantity: r for r in table.collect()}
    assert len(rows) == kept
    assert "has_promotion" not in table.columns and "temp_high_f" not in table.columns
    if n == 31:
        last = rows[31]
        assert (float(last.sales_lag_7), last.qty_lag_30, float(last.rolling_min_7), float(last.rolling_max_7)) == (240.0, 1, 240.0, 300.0)
        assert last.rolling_mean_7 == 270.0 and last.store_avg_daily_sales_30d == 155.0
        assert last.day_of_week is None  # outside the calendar


def test_rolling_edges(spark):
    rows = {r.daily_quantity: r for r in feat.feat_rolling(series(spark, 3)).collect()}
    assert rows[1].rolling_mean_7 is None
    assert rows[2].rolling_mean_7 == 10.0 and rows[2].rolling_std_7 is None  # deviation of one value
    assert rows[3].rolling_std_7 == pytest.approx(7.0710678)


def test_promotion_features(spark, promotions):
    df = series(spark, 4).select("date", "store_id", "product_id")
    got = {str(r.date): (r.has_promotion, r.promotion_discount) for r in feat.feat_promotion(df, promotions).collect()}
    assert got == {"2024-01-01": (True, 10), "2024-01-03": (True, 10), "2024-01-05": (True, 25), "2024-01-07": (False, 0)}
    none = feat.feat_promotion(df, None).collect()
    assert all((r.has_promotion, r.promotion_discount) == (False, 0) for r in none)


def test_feature_list():
    assert len(feat.FEATURES) == len(set(feat.FEATURES)) == 31 and feat.TARGET == "daily_quantity"


def test_other_lags_and_windows(spark):
    df = feat.feat_rolling(feat.feat_lags(series(spark, 3), lags=(1,)), windows=(2,))
    last = {r.daily_quantity: r for r in df.collect()}[3]
    assert (last.qty_lag_1, last.rolling_mean_2) == (2, 15.0) and "rolling_min_2" not in df.columns


def test_entity_means_equal_plain_windows(tables):
    from pyspark.sql import Window as W
    from pyspark.sql import functions as F

    from shelfline.operators.aggregates import daily_sales_agg
    daily = daily_sales_agg(tables.series_sales).select("date", "store_id", "product_id", "daily_revenue")
    means = ["store_avg_daily_sales_30d", "product_avg_daily_sales_30d"]
    plain = daily
    for out, entity, inner in zip(means, ("store_id", "product_id"), ("product_id", "store_id")):
        w = W.partitionBy(entity).orderBy(inner, "date").rowsBetween(-30, -1)
        plain = plain.withColumn(out, F.sum("daily_revenue").over(w).cast("double") / F.count("daily_revenue").over(w))
    cols = ["date", "store_id", "product_id", *means]
    want = sorted(tuple(r) for r in plain.select(*cols).na.fill(-1.0).collect())
    for cuts in (None, 3):
        assert sorted(tuple(r) for r in feat.feat_entity_avg(daily, cuts=cuts).select(*cols).na.fill(-1.0).collect()) == want


def test_whole_feature_table_equals_plain_windows(tables):
    from pyspark.sql import Window as W
    from pyspark.sql import functions as F

    from shelfline.operators.aggregates import daily_sales_agg
    daily = daily_sales_agg(tables.series_sales)
    rows = feat.feat_table(daily, tables.calendar, tables.series_stores, tables.series_products)
    series = W.partitionBy("store_id", "product_id").orderBy("date")
    store = W.partitionBy("store_id").orderBy("product_id", "date").rowsBetween(-30, -1)
    plain = daily.withColumn("sales_lag_7", F.lag("daily_revenue", 7).over(series)).withColumn(
        "store_avg_daily_sales_30d", F.sum("daily_revenue").over(store).cast("double") / F.count("daily_revenue").over(store))
    cols = ["date", "store_id", "product_id", "sales_lag_7", "store_avg_daily_sales_30d"]
    want = sorted(tuple(r) for r in plain.where("sales_lag_7 is not null").select(*cols).collect())
    assert sorted(tuple(r) for r in rows.select(*cols).collect()) == want and want


def test_entity_days(spark):
    rows = {r.daily_quantity: r for r in feat.feat_entity_avg(series(spark, 20), by_day=True).collect()}
    assert rows[1].store_avg_daily_sales_30d is None
    assert rows[20].store_avg_daily_sales_30d == sum(range(5, 20)) * 10 / 15  # 30 days hold 15 rows
