"""Every query that SQL can express against DuckDB, and the shape of the plans."""

import re
import sys
from pathlib import Path

import pytest
from retail_rows import SF
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as entry  # noqa: E402
from compare import connect, difference  # noqa: E402

from shelfline.operators.aggregates import daily_sales_agg  # noqa: E402
from shelfline.plans import eda, reports, summaries  # noqa: E402


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    df = entry.queries()[name](spark, SF)
    reason = difference(df, con.sql(entry.oracle_sql()[name]))
    # Some questions have an empty answer on the smallest data, on both sides.
    assert reason in (None, "no rows"), reason


def test_flagship(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) > 12 and rows[0].mom_growth_pct is None


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_cartesian_joins(tables):
    s, cs = tables.sales, tables.customer_sales
    for df in [reports.report_monthly_trends(cs), reports.report_store_ranking(tables.stores, cs),
               reports.report_category_abc(tables.products, s),
               reports.report_weather_impact(cs, tables.weather), reports.report_cohort_retention(cs),
               summaries.summary_customer_segments(cs), eda.eda_holiday_lift(s, tables.calendar)]:
        assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", plan(df))


def test_scans_are_pruned_and_filters_pushed(tables):
    df = daily_sales_agg(tables.sales.where("transaction_id > 5"))
    scan = df._jdf.queryExecution().sparkPlan().toString()
    columns = re.search(r"FileScan parquet \[([^\]]*)\]", scan).group(1)
    assert {c.split("#")[0] for c in columns.split(",")} == {
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_shipdate"}
    assert re.search(r"DataFilters: \[.*l_orderkey#\d+L > 5", scan)


def test_store_totals_are_partial_before_the_join(tables):
    text = plan(reports.store_metrics(tables.stores, tables.sales.withColumn("customer_id", F.col("store_id"))))
    assert "partial_sum" in text


def test_distinct_counts_do_not_copy_rows(tables):
    cs = tables.customer_sales
    for df in [reports.report_monthly_trends(cs), reports.report_store_ranking(tables.stores, cs),
               reports.report_category_abc(tables.products, tables.sales), reports.daily_store_sales(cs),
               summaries.summary_daily_sales(cs, tables.stores, tables.products), summaries.summary_weekly_performance(cs, tables.stores),
               summaries.summary_monthly_kpis(cs), entry.queries()["agg_count_distinct"](cs.sparkSession, SF)]:
        assert "Expand" not in plan(df)


def test_rankings_have_no_window_over_all_stores(tables):
    """The only un-partitioned windows run over block totals."""
    text = plan(reports.report_store_ranking(tables.stores, tables.customer_sales))
    for line in text.splitlines():
        if "Window [" in line and "windowspecdefinition(" in line and "_block" not in line:
            assert "partition" in line.lower() or "_blk" in line, line
