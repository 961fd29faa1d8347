"""Traps of the reports and summaries on hand-made rows."""

from retail_rows import day, money, sale
from pyspark.sql import functions as F

from shelfline.functions import exprs
from shelfline.operators.aggregates import daily_sales_agg
from shelfline.plans import eda, reports, summaries


def test_store_without_sales_ranks_last(spark, make_sales, stores):
    sales = make_sales([sale(1, "2024-01-01", 1, amount="50.00"), sale(2, "2024-01-02", 2, amount="90.00")])
    rows = {r.store_id: r for r in reports.report_store_ranking(stores, sales).collect()}
    assert [rows[i].overall_rank for i in (2, 1, 3)] == [1, 2, 3]
    assert rows[3].total_revenue is None and rows[3].transaction_count == 0
    assert rows[3].percentile_rank == 100.0 and rows[3].avg_daily_revenue is None
    assert rows[2].performance_quartile == 1


def test_number_of_blocks_changes_nothing(spark, tables):
    stores, sales, products = tables.stores, tables.customer_sales, tables.products
    before, seen = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for blocks in ("2", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", blocks)
            seen.append((reports.report_store_ranking(stores, sales).collect(), reports.report_category_abc(products, sales).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert seen[0] == seen[1] and len(seen[0][0]) == 10 and seen[0][1][-1].cumulative_pct == 100.0


def test_missing_month_shifts_comparison(make_sales):
    sales = make_sales([sale(1, "2024-01-05", amount="100.00"), sale(2, "2024-03-05", amount="150.00")])
    rows = reports.report_monthly_trends(sales).collect()
    assert [r.mom_growth_pct for r in rows] == [None, 50.0]
    resampled = {r.month_start: r.num_transactions for r in eda.eda_monthly_resample(sales).collect()}
    assert resampled == {day("2024-01-01"): 1, day("2024-02-01"): 0, day("2024-03-01"): 1}


def test_growth_from_zero_is_null(make_sales):
    sales = make_sales([sale(1, "2024-01-05", amount="0.00"), sale(2, "2024-02-05", amount="10.00")])
    assert reports.report_monthly_trends(sales).collect()[1].mom_growth_pct is None
    assert summaries.summary_monthly_kpis(sales).collect()[1].mom_growth_pct is None


def test_equal_categories_share_the_running_total(make_sales, products):
    sales = make_sales([sale(1, "2024-01-01", product=1, amount="40.00"), sale(2, "2024-01-01", product=2, amount="40.00"),
                        sale(3, "2024-01-01", product=3, amount="20.00")])
    rows = reports.report_category_abc(products, sales).collect()
    assert [float(r.cumulative_revenue) for r in rows] == [80.0, 80.0, 100.0]
    assert [r.category_rank for r in rows] == [1, 1, 3]
    assert [r.abc_classification[0] for r in rows] == ["A", "A", "C"]


def test_null_weather_falls_into_last_band(spark):
    df = spark.createDataFrame([(None, None), (31, None), (84, money("0.05")), (85, money("0.00"))], "t INT, p DECIMAL(5,2)")
    rows = df.select(exprs.temperature_band("t").alias("t"), exprs.precipitation_level("p").alias("p")).collect()
    assert [r.t for r in rows] == ["Hot (>85°F)", "Freezing (<32°F)", "Warm (70-85°F)", "Hot (>85°F)"]
    assert [r.p for r in rows] == ['Heavy Rain (>0.5")', 'Heavy Rain (>0.5")', 'Light Rain (<0.1")', "No Rain"]


def test_weather_report_keeps_null_condition(spark, make_sales):
    sales = make_sales([sale(1, "2024-01-01", 1), sale(2, "2024-01-01", 2)])
    weather = spark.createDataFrame([(day("2024-01-01"), 1, 40, 20, money("0.00"), None), (day("2024-01-01"), 2, 90, 80, money("1.00"), "Rain")],
                                    "date DATE, store_id INT, temp_high_f INT, temp_low_f INT, precipitation_inches DECIMAL(5,2), conditions STRING")
    rows = reports.report_weather_impact(sales, weather).collect()
    assert sorted((r.analysis_type, r.category or "") for r in rows) == sorted([
        ("By Condition", ""), ("By Condition", "Rain"), ("By Temperature", "Freezing (<32°F)"), ("By Temperature", "Hot (>85°F)"),
        ("By Precipitation", "No Rain"), ("By Precipitation", 'Heavy Rain (>0.5")')])
    assert all(r.revenue_std_dev is None for r in rows)  # one observation each
    assert all(r.avg_daily_units is None for r in rows if r.analysis_type == "By Precipitation")


def test_cohorts(make_sales):
    sales = make_sales([sale(1, "2024-01-31", customer=1), sale(2, "2024-02-01", customer=1, amount="30.00"), sale(3, "2024-01-02", customer=2),
                        sale(4, "2024-02-20", customer=3), sale(5, "2024-02-20", customer=None), sale(6, "2025-03-01", customer=2)])
    rows = {(str(r.cohort_month), r.cohort_period): r for r in reports.report_cohort_retention(sales).collect()}
    assert set(rows) == {("2024-01-01", 0), ("2024-01-01", 1), ("2024-02-01", 0)}  # period 14 is cut off
    first, second = rows["2024-01-01", 0], rows["2024-01-01", 1]
    assert (first.original_cohort_size, first.retention_rate_pct, first.retention_change_ppt) == (2, 100.0, None)
    assert (second.active_customers, second.retention_rate_pct, second.retention_change_ppt) == (1, 50.0, -50.0)
    assert second.cumulative_rev_per_customer == 25.0


def test_period_zero_is_always_whole(tables):
    rows = reports.report_cohort_retention(tables.customer_sales).where("cohort_period = 0").collect()
    assert rows and all(r.retention_rate_pct == 100.0 for r in rows)


def test_week_across_new_year_splits(make_sales, stores):
    sales = make_sales([sale(1, "2020-12-31"), sale(2, "2021-01-01")])
    rows = summaries.summary_weekly_performance(sales, stores).orderBy("year").collect()
    assert [(str(r.week_start), r.year, r.week_num) for r in rows] == [("2020-12-28", 2020, 53), ("2020-12-28", 2021, 53)]


def test_segments_and_tenure(make_sales):
    rows = [sale(i, "2024-01-01", customer=i, amount=f"{i * 10}.00") for i in range(1, 6)]
    rows += [sale(10 + i, f"2024-02-{i + 1:02d}", customer=5, amount="1.00") for i in range(9)]
    got = {r.customer_id: r for r in summaries.summary_customer_segments(make_sales(rows)).collect()}
    assert [got[i].value_segment for i in range(1, 6)] == ["Low Value", "Low Value", "Medium Value", "Medium Value", "High Value"]
    assert got[5].frequency_segment == "Loyal" and got[1].frequency_segment == "New"
    assert got[5].customer_tenure_days == 39


def test_counts_keep_or_drop_repeats_as_named(make_sales, stores, products):
    sales = make_sales([sale(1, "2024-01-01"), sale(1, "2024-01-01", pct=10)])
    daily = daily_sales_agg(sales).first()
    assert (daily.transaction_count, daily.discounted_count) == (2, 1)
    summary = summaries.summary_daily_sales(sales, stores, products).first()
    assert (summary.transaction_count, summary.discounted_transactions, summary.avg_discount_pct) == (1, 1, 5.0)


def test_daily_totals_add_up(tables):
    sales = tables.sales
    total = sales.agg(F.sum("total_amount")).first()[0]
    assert daily_sales_agg(sales).agg(F.sum("daily_revenue")).first()[0] == total


def test_copurchase_counts_customers_without_a_category(spark, make_sales, products):
    import numpy as np

    from shelfline.plans.eda import category_pairs, insight_copurchase
    rows = [sale(1, "2024-01-01", customer=1, product=1, amount="10.00"), sale(2, "2024-01-01", customer=1, product=2, amount="4.00"),
            sale(3, "2024-01-02", customer=2, product=1, amount="3.00"), sale(4, "2024-01-02", customer=3, product=2, amount="8.00"),
            sale(5, "2024-01-03", customer=4, product=1, amount="5.00"), sale(6, "2024-01-03", customer=4, product=1, amount="5.00")]
    got = {(r.category_a, r.category_b): r.correlation for r in insight_copurchase(make_sales(rows), products).collect()}
    want = np.corrcoef([10, 3, 0, 10], [4, 0, 8, 0])[0, 1]
    assert got == {("Beverages", "Dairy"): round(want, 6), ("Beverages", "Snacks"): None, ("Dairy", "Snacks"): None}
    assert category_pairs(products.limit(1)).count() == 0
