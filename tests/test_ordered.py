"""Block-wise order statistics against brute force, with ties, NULLs and a hot value."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from shelfline.operators import ordered as o
from shelfline.operators.features import previous_rows_mean


@pytest.fixture(scope="module")
def frame(spark):
    rnd = random.Random(7)
    values = [None] * 20 + [5.0] * 150 + [round(rnd.gauss(100, 40), 1) for _ in range(300)] + [1e9]
    rnd.shuffle(values)
    rows = [(i, None if v is None else int(v * 10), "ab"[i % 2]) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "id INT, v BIGINT, g STRING")


def as_dict(df, *cols):
    return {r.id: tuple(r[c] for c in cols) for r in df.collect()}


@pytest.mark.parametrize("by", [[], ["g"]])
@pytest.mark.parametrize("dense", [False, True])
def test_rank_equals_window(frame, by, dense):
    w = W.partitionBy(*by).orderBy(F.col("v").desc_nulls_last())
    plain = frame.withColumn("r", (F.dense_rank() if dense else F.rank()).over(w))
    blocked = o.add_rank(frame, "v", "r", by=by, dense=dense)
    assert as_dict(plain, "r") == as_dict(blocked, "r")


@pytest.mark.parametrize("tiles", [1, 4, 7, 1000])
def test_ntile_equals_window(frame, tiles):
    plain = frame.withColumn("t", F.ntile(tiles).over(W.orderBy(F.col("v").desc_nulls_last(), "id")))
    assert as_dict(plain, "t") == as_dict(o.add_ntile(frame, "v", "id", tiles, "t"), "t")


def test_percent_rank_equals_window(frame):
    plain = as_dict(frame.withColumn("p", F.percent_rank().over(W.orderBy(F.col("v").asc_nulls_last()))), "p")
    blocked = as_dict(o.add_percent_rank(frame, "v", "p"), "p")
    assert plain.keys() == blocked.keys()
    assert all(abs(plain[k][0] - blocked[k][0]) < 1e-12 for k in plain)


def test_running_total_shares_ties(frame):
    w = W.orderBy(F.col("v").desc_nulls_last())
    plain = frame.withColumn("run", F.sum("v").over(w)).withColumn("all", F.sum("v").over(W.partitionBy()))
    blocked = o.add_running_total(frame, "v", "run", "all")
    assert as_dict(plain, "run", "all") == as_dict(blocked, "run", "all")


@pytest.mark.parametrize("cuts", [1, 3, 256])
def test_order_stats_any_number_of_cuts(frame, cuts):
    got = {r.v: (r.n_le, r.d_le) for r in o.order_stats(frame, "v", cuts=cuts).collect()}
    values = [r.v for r in frame.collect()]
    for v, (n_le, d_le) in got.items():
        at_or_below = [x for x in values if x is None or (v is not None and x <= v)]
        assert (n_le, d_le) == (len(at_or_below), len(set(at_or_below)))


@pytest.mark.parametrize("p", [0.0, 0.25, 0.5, 0.8, 0.99, 1.0])
def test_exact_percentile(frame, p):
    values = [r.v for r in frame.collect() if r.v is not None]
    got = o.exact_percentiles(frame, "v", [p], ["q"]).first().q
    assert got == pytest.approx(np.percentile(values, p * 100), rel=1e-12)


def test_percentile_of_nothing(spark):
    empty = spark.createDataFrame([], "v DOUBLE")
    assert o.exact_percentiles(empty, "v", [0.5], ["q"]).first().q is None


def test_kth_smallest(frame):
    known = frame.where("v IS NOT NULL").select("v")
    values = sorted(r.v for r in known.collect())
    for k in (1, 2, 100, 170, len(values)):
        assert o.kth_smallest(known, "v", F.lit(k)).first().v == values[k - 1]
    assert o.kth_smallest(known, "v", F.lit(0)).first().v is None


@pytest.mark.parametrize("cuts", [1, 4, 256])
@pytest.mark.parametrize("rows", [1, 3, 30])
def test_blocked_rolling_mean(spark, cuts, rows):
    rnd = random.Random(3)
    data = []
    for store, products in ((1, 40), (2, 1), (3, 7)):
        for product in range(products):
            for d in range(rnd.choice([1, 2, 5, 12])):
                data.append((store, product, f"2024-01-{d + 1:02d}", rnd.randint(1, 1000)))
    df = spark.createDataFrame(data, "store_id INT, product_id INT, d STRING, v INT").select(
        "store_id", "product_id", F.col("d").cast("date").alias("date"), "v")
    w = W.partitionBy("store_id").orderBy("product_id", "date").rowsBetween(-rows, -1)
    key = lambda r: (r.store_id, r.product_id, r.date)
    want = {key(r): r.m for r in df.withColumn("m", F.avg("v").over(w)).collect()}
    got = {key(r): r.m for r in previous_rows_mean(df, "v", "store_id", "product_id", rows, "m", cuts=cuts).collect()}
    assert want.keys() == got.keys()
    assert all((want[k] is None and got[k] is None) or abs(want[k] - got[k]) < 1e-9 for k in want)


@pytest.mark.parametrize("top", [0, 100_000])
@pytest.mark.parametrize("n", [0, 1, 15, 170, 400, 10_000])
def test_first_rows(frame, monkeypatch, n, top):
    monkeypatch.setattr(o, "TOP_ROWS", top)
    rows = frame.select("v", "id")
    got = sorted(map(tuple, o.smallest_rows(rows, n, ["v", "id"]).collect()), key=str)
    assert got == sorted(map(tuple, rows.orderBy("v", "id").limit(n).collect()), key=str)


@pytest.mark.parametrize("top", [0, 100_000])
def test_first_rows_cuts_equal_rows(spark, monkeypatch, top):
    monkeypatch.setattr(o, "TOP_ROWS", top)
    df = spark.createDataFrame([(1,)] * 50 + [(2,)] * 50, "v INT")
    assert sorted(r.v for r in o.smallest_rows(df, 70, ["v"]).collect()) == [1] * 50 + [2] * 20


def test_few_rows_are_a_top_n(frame):
    plan = o.smallest_rows(frame, 15, ["v", "id"])._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "Exchange" not in plan
