"""Streaming jobs against their batch counterparts."""

import pytest
from retail_rows import money, sale
from pyspark.sql import functions as F

from shelfline.operators.aggregates import daily_sales_agg
from shelfline.operators.quality import QualityError
from shelfline.plans.incremental import LoadPaths, read_log
from shelfline.sources import versions
from shelfline.streaming import incremental as stream


def timed(df):
    return df.withColumn("sale_month", F.trunc("date", "MM")).withColumn("event_time", F.col("date").cast("timestamp"))


def loaded(df, at):
    return df.withColumn("sale_month", F.trunc("date", "MM")).withColumn("loaded_at", F.lit(f"2024-05-{at:02d} 00:00:00").cast("timestamp"))


def deliver(df, folder, name):
    df.coalesce(1).write.parquet(f"{folder}/{name}")


@pytest.fixture
def load(spark, tmp_path, make_sales, stores, products):
    folder, paths = str(tmp_path / "in"), LoadPaths(*[str(tmp_path / n) for n in ("table", "wm", "log")])
    schema = loaded(make_sales([sale(1, "2024-01-01")]), 1).schema

    def run(checkpoint="cp"):
        source = stream.file_stream(spark, f"{folder}/*", schema)
        stream.stream_incremental_load(spark, source, paths, str(tmp_path / checkpoint), stores, products).awaitTermination()
        return {r.transaction_id: r for r in versions.read(spark, paths.table).collect()}

    run.folder, run.log = folder, lambda: read_log(spark, paths.log)
    return run


def test_stream_load_updates_and_takes_repeats(spark, load, make_sales):
    rows = make_sales([sale(1, "2024-01-01"), sale(2, "2024-01-02")])
    deliver(loaded(rows, 1), load.folder, "a")
    assert set(load()) == {1, 2}
    deliver(loaded(rows.where("transaction_id = 2"), 2), load.folder, "b")  # repeated delivery
    deliver(loaded(make_sales([sale(1, "2024-01-01", qty=6, amount="60.00"), sale(3, "2024-02-01")]), 3), load.folder, "c")
    got = load()
    assert set(got) == {1, 2, 3} and got[1].quantity == 6 and got[1].total_amount == money("60.00")
    assert [r.row_count for r in load.log().orderBy("refresh_timestamp").collect()] == [2, 3]
    deliver(loaded(make_sales([sale(9, "2024-02-02", store=99)]), 4), load.folder, "d")
    with pytest.raises(Exception) as err:
        load()
    assert QualityError.__name__ in str(err.value) or "orphaned_store_ids" in str(err.value)


def test_late_rows_and_late_changes_are_loaded(load, make_sales):
    deliver(loaded(make_sales([sale(1, "2020-01-05"), sale(2, "2024-12-31")]), 1), load.folder, "a")
    load()
    deliver(loaded(make_sales([sale(1, "2020-01-05", qty=4), sale(3, "2021-06-01"), sale(4, "2025-01-01")]), 2), load.folder, "b")
    got = load()
    assert set(got) == {1, 2, 3, 4} and got[1].quantity == 4


def test_backlog_of_two_deliveries_keeps_the_later(load, make_sales):
    deliver(loaded(make_sales([sale(1, "2024-01-01"), sale(2, "2024-01-01")]), 1), load.folder, "a")
    deliver(loaded(make_sales([sale(1, "2024-01-01", qty=9)]), 2), load.folder, "b")
    got = load()
    assert set(got) == {1, 2} and got[1].quantity == 9


def test_conflict_inside_one_delivery_fails(load, make_sales):
    deliver(loaded(make_sales([sale(1, "2024-01-01"), sale(1, "2024-01-01", qty=9)]), 1), load.folder, "a")
    with pytest.raises(Exception) as err:
        load()
    assert "duplicate_keys" in str(err.value)


def test_replayed_batch_has_one_log_row(load, make_sales):
    deliver(loaded(make_sales([sale(1, "2024-01-01")]), 1), load.folder, "a")
    first = load()
    assert load("another-checkpoint") == first  # batch 0 once more
    assert load.log().count() == 1


def test_stream_daily_equals_batch_with_late_rows_and_replays(spark, tmp_path, make_sales):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    parts = [make_sales([sale(1, "2024-01-01"), sale(2, "2024-01-01", pct=5), sale(3, "2024-01-02", store=2)]),
             make_sales([sale(4, "2024-02-01")]), make_sales([sale(5, "2024-01-01", qty=3), sale(6, "2024-03-01")])]

    def run(checkpoint="cp"):
        source = stream.file_stream(spark, f"{folder}/*", timed(parts[0]).schema)
        stream.stream_daily_sales(source, out, str(tmp_path / checkpoint)).awaitTermination()

    seen = None
    for name, part in zip("abc", parts):  # the last brings a row of the first day
        deliver(timed(part), folder, name)
        run()
        seen = part if seen is None else seen.unionByName(part)
        want = daily_sales_agg(seen)
        got = stream.read_daily(spark, out).select(*want.columns)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    run()  # nothing new
    assert sorted(map(tuple, stream.read_daily(spark, out).select(*want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_replayed_daily_batch_counts_once(spark, tmp_path, make_sales):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    deliver(timed(make_sales([sale(1, "2024-01-01")])), folder, "a")
    for checkpoint in ("cp", "lost"):  # batch 0 twice
        source = stream.file_stream(spark, f"{folder}/*", timed(make_sales([sale(1, "2024-01-01")])).schema)
        stream.stream_daily_sales(source, out, str(tmp_path / checkpoint)).awaitTermination()
    assert [r.transaction_count for r in stream.read_daily(spark, out).collect()] == [1]
