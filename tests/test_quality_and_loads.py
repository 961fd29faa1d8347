"""Quality checks, sources and incremental loads."""

import pytest
from retail_rows import day, money, sale
from pyspark.sql import functions as F

from shelfline import schemas
from shelfline.operators import quality as q
from shelfline.operators.encoding import LabelCodes, fit_label_codes
from shelfline.operators.sampling import sample_rows
from shelfline.plans import incremental as inc
from shelfline.sources import versions
from shelfline.sources import tables as src


def counts(df):
    return {r.check_name: r.issue_count for r in df.collect()}


def test_checks(spark, make_sales, stores, products):
    sales = make_sales([sale(1, "2024-01-01"), sale(1, "2024-01-01", store=9), sale(None, "2031-01-01", product=None, qty=-1)])
    assert counts(q.dq_nulls(sales, ["transaction_id", "product_id", "date"])) == {"null_transaction_id": 1, "null_product_id": 1, "null_date": 0}
    assert counts(q.dq_negative(sales, ["quantity", "total_amount"])) == {"negative_quantity": 1, "negative_total_amount": 0}
    assert counts(q.dq_duplicate_keys(sales, "transaction_id")) == {"duplicate_keys": 2}
    assert counts(q.dq_orphans(sales, stores, "store_id")) == {"orphaned_store_ids": 1}
    assert counts(q.dq_orphans(sales, products, "product_id")) == {"orphaned_product_ids": 1}
    bounds = q.dq_bounds(sales, {"date": (day("2010-01-01"), day("2030-12-31"))}, {"quantity": (0.99, 1000)})
    assert counts(bounds) == {"date_out_of_range": 1, "quantity_q99_too_high": 0}
    assert counts(q.dq_price_gt_cost(products.withColumn("unit_cost", F.lit(3)))) == {"price_not_above_cost": 1}
    profile = {r.column_name: (r.data_type, r.row_count, r.missing) for r in q.dq_profile(sales).collect()}
    assert profile["product_id"] == ("int", 3, 1) and len(profile) == 10
    done = q.dq_completeness({"stores": stores, "products": products, "calendar": None}, {"stores": 5, "products": 3})
    assert counts(done) == {"missing_calendar": 1, "too_few_products": 0, "too_few_stores": 1}
    with pytest.raises(q.QualityError, match="too_few_stores: 1"):
        q.assert_clean(done)
    with pytest.raises(q.QualityError, match="missing columns.*'b', 'c'"):
        q.require_columns(spark.range(1).toDF("a"), ["a", "b", "c"], "t")


def test_clean_table_passes(make_sales, stores, products):
    sales = make_sales([sale(1, "2024-01-01"), sale(2, "2024-01-02")])
    assert counts(inc.staging_checks(sales, stores, products)) == {
        "null_required": 0, "duplicate_keys": 0, "orphaned_store_ids": 0, "orphaned_product_ids": 0}


@pytest.mark.parametrize("bad", [sale(1, "2024-01-01"), sale(None, "2024-01-01"), sale(3, "2024-01-01", store=77)])
def test_gate_stops_bad_rows(make_sales, stores, products, bad):
    with pytest.raises(q.QualityError):
        inc.staging_checks(make_sales([sale(1, "2024-01-01"), bad]), stores, products)


def test_upsert_changes_three_columns_only(make_sales):
    target = make_sales([sale(1, "2024-01-01", qty=2, amount="20.00", pct=5), sale(2, "2024-01-02")])
    staged = make_sales([sale(1, "2024-06-06", store=3, qty=7, amount="99.00"), sale(3, "2024-01-03", amount="5.00")]).withColumn(
        "discount_percent", F.lit(None).cast("int"))
    got = {r.transaction_id: r for r in inc.upsert(target, staged, "transaction_id").collect()}
    assert set(got) == {1, 2, 3}
    assert (got[1].quantity, got[1].total_amount, got[1].discount_percent) == (7, money("99.00"), None)
    assert (got[1].date, got[1].store_id, got[1].unit_price, got[1].discount_applied) == (day("2024-01-01"), 1, money("10.00"), True)
    assert got[3].total_amount == money("5.00") and got[2].quantity == 1


def load_paths(tmp_path):
    return inc.LoadPaths(*[str(tmp_path / n) for n in ("table", "watermark", "log")])


def monthly(df):
    return df.withColumn("sale_month", F.trunc("date", "MM"))


def test_incremental_run(spark, tmp_path, make_sales, stores, products):
    paths = load_paths(tmp_path)
    first = monthly(make_sales([sale(1, "2024-01-01"), sale(2, "2024-02-01")]))
    row = inc.run_incremental(spark, first, paths, stores, products).first()
    assert (row.status, str(row.latest_date), row.rows_loaded) == ("Incremental Load Complete", "2024-02-01", 2)
    more = first.unionByName(monthly(make_sales([sale(3, "2024-02-05")])))
    row = inc.run_incremental(spark, more, paths, stores, products).first()
    assert (str(row.latest_date), row.rows_loaded) == ("2024-02-05", 1)
    row = inc.run_incremental(spark, more, paths, stores, products).first()  # nothing new
    assert (str(row.latest_date), row.rows_loaded) == ("2024-02-05", 0)
    assert versions.read(spark, paths.table).count() == 3
    assert inc.read_log(spark, paths.log).select("refresh_id").distinct().count() == 3
    mark = inc.read_watermark(spark, paths.watermark, paths.name).first()
    assert (mark.last_loaded_id, str(mark.last_loaded_date)) == (3, "2024-02-05")


def test_the_pass_that_writes_a_stage_counts_it(spark, make_sales):
    rows = make_sales([sale(1, "2024-01-01"), sale(7, "2024-02-03")]).unionByName(make_sales([sale(3, "2024-01-02")]).withColumn("store_id", F.lit(None).cast("int")))
    staged, seen = inc.stage(rows)
    assert (seen["rows"], seen["null_required"], str(seen["last_date"]), seen["last_key"]) == (3, 1, "2024-02-03", 7)
    assert staged.count() == 3
    counts = inc.staging_checks(staged, fail_on_issue=False, seen=seen)
    assert {r.check_name: r.issue_count for r in counts.collect()} == {"null_required": 1, "duplicate_keys": 0}
    # The null check reads nothing more.
    assert counts.where("check_name = 'null_required'")._jdf.queryExecution().executedPlan().toString().count("FileScan") <= 1
    none, seen = inc.stage(rows.limit(0))
    assert (seen["rows"], seen["last_key"], none.count()) == (0, None, 0)


def test_merge_follows_the_key_and_repeats_change_nothing(spark, tmp_path, make_sales):
    path = str(tmp_path / "t")
    inc.merge_into(spark, path, monthly(make_sales([sale(1, "2024-01-01"), sale(2, "2024-02-01"), sale(3, "2024-03-01")])),
                   "transaction_id", inc.UPDATED_ON_CONFLICT, "sale_month")
    # Key 1 lives in January though the staged row says February.
    staged = monthly(make_sales([sale(1, "2024-02-09", qty=8)]))
    for _ in range(3):
        inc.merge_into(spark, path, staged, "transaction_id", inc.UPDATED_ON_CONFLICT, "sale_month")
        rows = {r.transaction_id: r for r in versions.read(spark, path).collect()}
        assert len(rows) == 3 and rows[1].quantity == 8 and str(rows[1].date) == "2024-01-01" and str(rows[1].sale_month) == "2024-01-01"
    kept = [p.name for p in (tmp_path / "t").iterdir() if p.is_dir()]
    state = versions.current(spark, path)
    assert sorted(kept) == sorted([state["version"], state["previous"]])
    assert "sale_month" in versions.read(spark, path).columns and versions.read(spark, path).where("sale_month = '2024-03-01'").count() == 1


def test_crash_between_write_and_switch_loses_nothing(spark, tmp_path, make_sales, monkeypatch):
    path = str(tmp_path / "t")
    args = ("transaction_id", inc.UPDATED_ON_CONFLICT, "sale_month")
    inc.merge_into(spark, path, monthly(make_sales([sale(1, "2024-01-01"), sale(2, "2024-01-02")])), *args)
    staged = monthly(make_sales([sale(2, "2024-01-02", qty=5), sale(3, "2024-01-03")]))
    with monkeypatch.context() as m:
        m.setattr(versions, "switch", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            inc.merge_into(spark, path, staged, *args)
    assert {r.transaction_id: r.quantity for r in versions.read(spark, path).collect()} == {1: 1, 2: 1}
    inc.merge_into(spark, path, staged, *args)
    assert {r.transaction_id: r.quantity for r in versions.read(spark, path).collect()} == {1: 1, 2: 5, 3: 1}


def test_empty_state_and_rows_without_partition_value(spark, tmp_path, make_sales):
    path = str(tmp_path / "t")
    rows = monthly(make_sales([sale(1, "2024-01-01")]))
    versions.replace(rows.limit(0), path, "sale_month")
    assert versions.read(spark, path).count() == 0 and versions.read(spark, path).columns == rows.columns
    versions.replace(rows.withColumn("sale_month", F.lit(None).cast("date")), path, "sale_month")
    assert versions.read(spark, path).first().sale_month is None


def test_bounds_may_be_open(spark):
    from shelfline.operators.quality import Range, dq_bounds
    df = spark.createDataFrame([(0.0,), (5.0,), (10.0,), (None,)], "p DOUBLE")
    count = lambda r: dq_bounds(df, {"p": r}).first().issue_count
    assert [count(x) for x in ((0, 10), Range(0, 10, low_open=True), Range(0, 10, True, True))] == [0, 1, 2]


def test_csv_round_trip(spark, tmp_path, stores, make_sales):
    base = str(tmp_path)
    make_sales([sale(1, "2024-01-01", customer=None), sale(2, "2024-02-02")]).write.option("header", True).csv(f"{base}/in/sales_transactions.csv")
    src.bulk_copy(spark, f"{base}/in", f"{base}/out", tables=["sales_transactions"])
    back = spark.read.parquet(f"{base}/out/sales_transactions.parquet")
    assert {str(r.sale_month) for r in back.collect()} == {"2024-01-01", "2024-02-01"}
    assert back.where("customer_id IS NULL").count() == 1 and dict(back.dtypes)["total_amount"] == "decimal(12,2)"
    with pytest.raises(src.MissingTable):
        src.load_table(spark, base, "weather")
    (tmp_path / "stores.csv").write_text("store_id,store_name,region,store_format,size_sqft,open_date,latitude,longitude,manager_count,employee_count\n"
                                         "x,One,North,Express,oops,2020-01-01,1,2,3,4\n")
    with pytest.raises(Exception):
        src.load_table(spark, base, "stores", "csv").collect()


def test_limited_load_is_deterministic(spark, tmp_path, make_sales):
    rows = make_sales([sale(i, "2024-01-01") for i in range(50, 0, -1)])
    rows.repartition(5).write.parquet(str(tmp_path / "sales_transactions.parquet"))
    got = src.load_sales_limited(spark, str(tmp_path), 3).collect()
    assert [r.transaction_id for r in got] == [1, 2, 3]
    assert src.parameterized_query(spark, "SELECT * FROM {s} WHERE transaction_id > :n ORDER BY transaction_id", {"n": 10}, first=True,
                                   s=rows).first().transaction_id == 11
    assert set(schemas.TABLES) == set(schemas.DIMENSIONS) | {"sales_transactions"}


def test_sample_is_stable(spark):
    df = spark.range(1000)
    a = {r.id for r in sample_rows(df, 100).collect()}
    b = {r.id for r in sample_rows(df.repartition(7), 100).collect()}
    assert a == {r.id for r in sample_rows(df.repartition(3), 100).collect()}
    assert a == b and len(a) == 100 and a != {r.id for r in sample_rows(df, 100, seed=1).collect()}


def test_label_codes(spark, tmp_path):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",), ("a",)], "x STRING")
    codes = fit_label_codes(df, ["x"])
    new = spark.createDataFrame([("a",), ("c",), ("zz",), (None,)], "x STRING")
    want = {"a": 0, "c": 2, "zz": 0, None: 0}
    assert {r.x: r.x_code for r in codes.transform(new).collect()} == want
    codes.save(str(tmp_path))
    assert {r.x: r.x_code for r in LabelCodes.load(spark, str(tmp_path), ["x"]).transform(new).collect()} == want


def test_text_copies_are_stored_compressed(spark, tables, tmp_path, monkeypatch):
    from shelfline.catalog import core
    monkeypatch.setattr(core, "fresh_path", lambda spark, name: str(tmp_path / name))
    target = core.copied(tables)
    plain = [p for p in (tmp_path / "csv").rglob("part-*") if p.suffix == ".csv"]
    assert not plain
    assert spark.read.parquet(f"{target}/sales_transactions.parquet").count() == tables.customer_sales.count()
