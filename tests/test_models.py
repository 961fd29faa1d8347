"""Split, metrics, models, scoring and forecasts."""

import datetime as dt
import random

import numpy as np
import pytest
from retail_rows import day, money
from pyspark.sql import functions as F

from shelfline.operators import evaluation as ev
from shelfline.operators.split import split_report, time_folds, time_split
from shelfline.plans import forecasts as fc
from shelfline.plans import training as tr


def keyed(spark, n=997, days=9):
    rnd = random.Random(1)
    keys = sorted({(day("2024-01-01") + dt.timedelta(days=min(rnd.randint(0, days), rnd.randint(0, days))), rnd.randint(1, 30), rnd.randint(1, 30)) for _ in range(n)})
    df = spark.createDataFrame(keys, "date DATE, store_id INT, product_id INT").repartition(5)
    return keys, df


@pytest.mark.parametrize("test_size", [0.2, 0.5, 0.0, 1.0])
def test_split_is_the_sorted_prefix(spark, test_size):
    keys, df = keyed(spark)
    train, test = time_split(df, test_size)
    cut = int(len(keys) * (1 - test_size))
    assert sorted(map(tuple, train.collect())) == keys[:cut]
    assert sorted(map(tuple, test.collect())) == keys[cut:]


def test_split_report(spark):
    keys, df = keyed(spark)
    rows = {r.part: r for r in split_report(*time_split(df)).collect()}
    assert rows["train"].row_count + rows["test"].row_count == len(keys)
    assert rows["train"].last_date <= rows["test"].first_date


def test_folds_are_contiguous(spark):
    keys, df = keyed(spark)
    got = {(r.date, r.store_id, r.product_id): r.fold for r in time_folds(df, 4).collect()}
    sizes = [len(keys) // 4 + (i < len(keys) % 4) for i in range(4)]
    want = [i for i, s in enumerate(sizes) for _ in range(s)]
    assert [got[k] for k in keys] == want


def test_metrics(spark):
    rows = [(10.0, 12.0), (0.0, 1.0), (20.0, 15.0), (5.0, 5.0)]
    df = spark.createDataFrame(rows, "actual DOUBLE, prediction DOUBLE")
    m = ev.metrics_regression(df).first()
    y, p = np.array(rows).T
    assert m.rmse == round(float(np.sqrt(((y - p) ** 2).mean())), 4) and m.mae == 2.0
    assert m.mape == round(float(np.mean([0.2, 0.25, 0.0]) * 100), 4)
    assert m.r2 == round(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum(), 4) and m.forecast_bias == -0.5
    zero = ev.metrics_regression(df.withColumn("actual", F.lit(0.0))).first()
    assert zero.mape is None and zero.r2 is None


def test_select_best(spark):
    df = spark.createDataFrame([(0, "a", 2.0, 9.0, 0.5), (1, "b", 1.0, 7.0, 0.9), (2, "c", 1.0, 8.0, 0.9)],
                               "position INT, model STRING, rmse DOUBLE, mape DOUBLE, r2 DOUBLE")
    assert [ev.select_best(df, m).first().best_model for m in ("rmse", "r2", "mape")] == ["b", "b", "b"]


def test_errors_and_ensemble(spark):
    long = spark.createDataFrame([(1, "a", 10.0, 8.0), (1, "b", 10.0, 14.0), (2, "a", 0.0, 2.0), (2, "b", 0.0, 4.0)],
                                 "id INT, model STRING, actual DOUBLE, prediction DOUBLE")
    got = {r.id: r for r in ev.ensemble(long, ["id"]).collect()}
    assert (got[1].simple, got[2].simple) == (11.0, 3.0)
    assert got[1].weighted == pytest.approx((8 / 2 + 14 / 4) / (1 / 2 + 1 / 4))
    report = {r.model: r for r in ev.ensemble_report(long, ["id"]).collect()}
    assert report["Simple Ensemble"].rmse == round(5 ** 0.5, 4) and report["Simple Ensemble"].improvement_pct < 0
    seg = {(r.segment, r.value): r for r in ev.error_by_segment(long, ["model"]).collect()}
    assert seg["model", "a"].mean_pct_error == 10.0 and seg["model", "b"].mae == 4.0


def training_frame(spark, n=600):
    rnd = np.random.default_rng(5)
    x = rnd.normal(size=(n, 3)) * [1, 5, 0.2] + [0, 10, 3]
    y = 3 * x[:, 0] - 0.5 * x[:, 1] + rnd.normal(size=n) + 20
    rows = [(day("2024-01-01") + dt.timedelta(days=i // 6), i % 6, 1, float(y[i]), *map(float, x[i])) for i in range(n)]
    return spark.createDataFrame(rows, "date DATE, store_id INT, product_id INT, daily_quantity DOUBLE, a DOUBLE, b DOUBLE, c DOUBLE"), x, y


def test_penalised_models_equal_their_closed_form(spark):
    df, x, y = training_frame(spark)
    prepared = tr.prepare(df, ["a", "b", "c", "absent"])
    assert prepared.missing == ["absent"] and prepared.rows == 480
    n = 480
    z = (x[:n] - x[:n].mean(0)) / x[:n].std(0, ddof=1)
    t = y[:n] - y[:n].mean()
    specs = [s for s in tr.model_specs() if s.name in ("LinearRegression", "Ridge", "Lasso")]
    got = {r.name: r for r in tr.train_all(prepared, specs)}
    coef = {k: r.model.stages[-1].coefficients.toArray() for k, r in got.items()}
    assert coef["LinearRegression"] == pytest.approx(np.linalg.lstsq(z, t, rcond=None)[0], abs=1e-6)
    assert coef["Ridge"] == pytest.approx(np.linalg.solve(z.T @ z + np.eye(3), z.T @ t), abs=1e-4)
    w = np.zeros(3)
    for _ in range(500):
        for j in range(3):
            r = t - z @ w + z[:, j] * w[j]
            rho = z[:, j] @ r / n
            w[j] = np.sign(rho) * max(abs(rho) - 0.1, 0) / (z[:, j] @ z[:, j] / n)
    assert coef["Lasso"] == pytest.approx(w, abs=1e-3)
    assert all(r.cv_rmse > 0 and r.test_metrics["r2"] > 0.8 for r in got.values())


def test_failing_model_is_left_out_and_models_reload(spark, tmp_path):
    df, *_ = training_frame(spark, 300)
    prepared = tr.prepare(df, ["a", "b", "c"])

    def broken(n, s):
        raise RuntimeError("no such library")

    specs = [tr.Spec("Broken", broken), *[s for s in tr.model_specs() if s.name in ("LinearRegression", "Lasso")]]
    results = tr.train_all(prepared, specs, folds=2)
    assert [r.name for r in results] == ["LinearRegression", "Lasso"]
    assert tr.results_summary(spark, results).columns == tr.RESULT_COLUMNS
    path = str(tmp_path / "m")
    tr.save_models(spark, results, path, "LinearRegression", prepared.names)
    name, model, names = tr.load_best(spark, path)
    assert name == "linearregression" and names == ["a", "b", "c"]
    fresh = tr.encode_features(df, names)[0]
    ours = model.transform(fresh).agg(F.sum("prediction")).first()[0]
    assert ours == pytest.approx(results[0].model.transform(fresh).agg(F.sum("prediction")).first()[0])
    tr.save_models(spark, results[1:], str(tmp_path / "n"), "Gone", prepared.names)
    assert tr.load_best(spark, str(tmp_path / "n"))[0] == "lasso"


class Unfit:
    """Stands in for an estimator that cannot be fitted; notes how often it is asked."""

    def __init__(self):
        self.asked = 0

    def extractParamMap(self):
        return {}

    def fit(self, df):
        self.asked += 1
        raise RuntimeError("no such rows")


def test_cv_report_does_not_pass_over_a_failed_model(spark):
    df, *_ = training_frame(spark, 300)
    prepared, bad = tr.prepare(df, ["a", "b", "c"]), Unfit()
    specs = [tr.Spec("Bad", lambda n, s: bad), *[s for s in tr.model_specs() if s.name == "Ridge"]]
    for work in (lambda: tr.cv_report(spark, specs, prepared, 2), lambda: tr.fold_rmse(specs, prepared, 2),
                 lambda: tr.cross_validate(specs[0], prepared, 2)):
        with pytest.raises(tr.TrainingFailed, match="2 of 2 fits failed: Bad: RuntimeError: no such rows"):
            work()
    assert bad.asked == 6  # the first failure does not stop the other folds
    assert [r.model for r in tr.cv_report(spark, specs[1:], prepared, 2).collect()] == ["Ridge"]


def test_a_fold_without_rows_is_a_failure(spark):
    from pyspark.ml.regression import DecisionTreeRegressor
    df, *_ = training_frame(spark, 3)
    prepared = tr.prepare(df, ["a"], 0.0)
    tree = tr.Spec("Tree", lambda n, s: DecisionTreeRegressor(labelCol=tr.TARGET, featuresCol="features", maxDepth=1))
    with pytest.raises(tr.TrainingFailed, match="1 of 4 fits failed: Tree: ValueError: no rows to score in fold 3 of 4"):
        tr.fold_rmse([tree], prepared, 4)


def planted(spark, monkeypatch, bad):
    """Small models under the names of the tree models, one of which cannot be fitted; runs queries on them."""
    from types import SimpleNamespace

    from pyspark.ml.regression import DecisionTreeRegressor
    from shelfline.catalog import REGISTRY, forecasting
    df, *_ = training_frame(spark, 120)
    prepared = tr.prepare(df, ["a", "b", "c"])
    good = [tr.Spec(f, lambda n, s, k=k: DecisionTreeRegressor(labelCol=tr.TARGET, featuresCol="features", maxDepth=k))
            for k, f in enumerate(["RandomForest", "BoostedDepthwise"], 1)]
    monkeypatch.setattr(tr, "model_specs", lambda: [tr.Spec("BoostedLeafy", lambda n, s: bad), *good])
    monkeypatch.setattr(forecasting, "prepared_of", lambda t, features=None: prepared)
    return lambda name: REGISTRY[name].run(SimpleNamespace(spark=spark)).collect()


@pytest.mark.parametrize("name", ["feature_importance", "feature_importance_by_model"])
def test_importance_does_not_pass_over_a_failed_model(spark, monkeypatch, name):
    run = planted(spark, monkeypatch, Unfit())
    with pytest.raises(tr.TrainingFailed, match="1 of 3 fits failed: BoostedLeafy: RuntimeError: no such rows"):
        run(name)


@pytest.mark.parametrize("name", ["results_summary", "train_all", "train_gbt", "learning_curve"])
def test_summaries_do_not_pass_over_a_failed_model(spark, monkeypatch, name):
    bad = Unfit()
    run = planted(spark, monkeypatch, bad)
    with pytest.raises(tr.TrainingFailed, match="fits failed: BoostedLeafy: RuntimeError: no such rows"):
        run(name)
    assert bad.asked == (4 if name == "results_summary" else 1)  # the first failure does not stop the folds


def test_summary_has_every_model(spark, monkeypatch):
    from pyspark.ml.regression import DecisionTreeRegressor
    fit = DecisionTreeRegressor(labelCol=tr.TARGET, featuresCol="features", maxDepth=3)
    rows = planted(spark, monkeypatch, fit)("results_summary")
    assert {r.Model for r in rows} == {"BoostedLeafy", "RandomForest", "BoostedDepthwise"} and all(None not in r for r in rows)


def test_tree_importance(spark):
    df, *_ = training_frame(spark, 300)
    prepared = tr.prepare(df, ["a", "b", "c"])
    from pyspark.ml.regression import RandomForestRegressor
    forest = tr.Spec("Forest", lambda n, s: RandomForestRegressor(labelCol=tr.TARGET, featuresCol="features", numTrees=5, seed=1))
    results = tr.train_all(prepared, [forest], folds=0)
    imp = tr.feature_importance(spark, results, prepared.names)
    assert imp.agg(F.sum("importance")).first()[0] == pytest.approx(1.0)
    assert {r.feature for r in tr.top_features(imp, 2).collect()} == {"a", "b"}  # the third only adds noise
    assert tr.importance_by_model(imp, ["Forest"], 2).columns == ["feature", "Forest"]
    assert tr.predictions_long(results, prepared).count() == 60


def test_scoring(spark):
    names = ["qty_lag_7", "product_price"]
    rows = [(day("2024-01-01") + dt.timedelta(days=i), 1, 1, float(i), float(i), 2.0) for i in range(40)]
    features = spark.createDataFrame(rows, "date DATE, store_id INT, product_id INT, daily_quantity DOUBLE, qty_lag_7 DOUBLE, product_price DOUBLE")
    prepared = tr.prepare(features, names)
    spec = next(s for s in tr.model_specs() if s.name == "LinearRegression")
    model = tr.train_all(prepared, [spec], folds=0)[0].model
    requests = spark.createDataFrame([(1, 1, 7), (1, 2, 14), (None, 1, 30), (1, 1, None)], "store_id INT, product_id INT, horizon INT")
    got = fc.score_batch(requests, features, model, "LinearRegression", names).collect()
    by = {(r.store_id, r.product_id, r.horizon_days): r for r in got}
    assert len(got) == 4
    assert by[1, 1, 7].predicted_quantity == 39.0 and by[1, 1, 7].has_history
    assert by[1, 2, 14].predicted_quantity == 50.0 and not by[1, 2, 14].has_history  # default lag
    assert by[None, 1, 30].error == "missing key" and by[None, 1, 30].predicted_quantity is None


def test_requests(spark, stores, products):
    rows = [(1, 1, 7), (0, 1, 7), (1, 9, 7), (3, 3, 10), (None, 1, 14), (2, 2, 30)]
    requests = spark.createDataFrame(rows, "store_id INT, product_id INT, horizon INT")
    got = [r.reason for r in fc.validate_requests(requests, stores, products).collect()]
    assert got == [None, "invalid store_id", "invalid product_id", "invalid horizon", "invalid store_id", None]


def test_curve_and_insights(spark, products):
    base = spark.createDataFrame([(1, 1, 7, day("2024-01-04"), 20.0)], "store_id INT, product_id INT, horizon_days INT, forecast_date DATE, predicted_quantity DOUBLE")
    curve = fc.forecast_expand(base).orderBy("target_date").collect()
    # Friday, Saturday and Sunday with weekend share, then Monday to Thursday.
    assert [r.value for r in curve] == [20, 22, 22, 20, 20, 21, 21]
    assert (curve[0].lower_bound, curve[0].upper_bound, str(curve[-1].target_date)) == (17, 23, "2024-01-11")
    i = fc.forecast_insights(fc.forecast_expand(base)).first()
    assert (i.total_forecast, i.min_value, i.max_value, i.safety_stock, i.total_inventory) == (146, 20, 22, 3, 167)
    assert i.peak_days == "2024-01-06,2024-01-07" and i.variability_pct == 9.6 and not i.high_variability
    rows = fc.forecast_rows(fc.forecast_expand(base), "m", price=products)
    assert rows.orderBy("target_date").first().predicted_revenue == 59.8
    stored = fc.forecast_store(rows, fc.forecast_rows(fc.forecast_expand(base.withColumn("predicted_quantity", F.lit(40.0))), "m", "2.0"))
    assert stored.count() == 7 and stored.agg(F.min("predicted_quantity")).first()[0] == 40.0
    daily = spark.createDataFrame([(day("2024-01-05"), 1, 1, 25, money("50.00"))], "date DATE, store_id INT, product_id INT, daily_quantity BIGINT, daily_revenue DECIMAL(12,2)")
    filled = {str(r.target_date): r for r in fc.forecast_backfill(rows, daily).collect()}
    assert (filled["2024-01-05"].absolute_error, filled["2024-01-05"].percentage_error) == (5.0, 20.0)
    assert filled["2024-01-06"].actual_quantity is None


class Seen(Exception):
    pass


class Recorder:
    """Stands in for an estimator: notes the partitions it is given."""

    def __init__(self):
        self.tasks = []

    def extractParamMap(self):
        return {}

    def fit(self, df):
        self.tasks.append(df.rdd.getNumPartitions())
        raise Seen


def test_fits_get_few_tasks_and_run_side_by_side(spark):
    seen, start = Recorder(), day("2000-01-01")
    rows = spark.range(0, 60_000, 1, 6).select(
        F.date_add(F.lit(start), (F.col("id") / 25).cast("int")).alias("date"), (F.col("id") % 5).cast("int").alias("store_id"),
        (F.col("id") % 25).cast("int").alias("product_id"), F.rand(1).alias("product_price"), F.rand(2).alias(tr.TARGET))
    prepared = tr.prepare(rows, ["product_price"], 0.0)
    spec = tr.Spec("noted", lambda n, s: seen)
    for work in (lambda: tr.fit_model(spec, prepared), lambda: tr.one_fold(spec, prepared, prepared.folds(3), 0, 3)):
        with pytest.raises(Seen):
            work()
    assert seen.tasks == [1, 1]
    assert prepared.train.count() == 60_000
    assert prepared.at_once() == 3 * spark.sparkContext.defaultParallelism
    assert [tr.fit_tasks(n) for n in (0, 75_000, 75_001, 7_500_000)] == [1, 1, 2, 100]


def test_fits_side_by_side_share_the_cores(spark):
    """Fits on 240,000 rows get as many tasks as there are cores for them, and full and fold fits run in one pool."""
    import threading
    seen, start = Recorder(), day("2000-01-01")
    rows = spark.range(0, 240_000, 1, 8).select(
        F.date_add(F.lit(start), (F.col("id") / 25).cast("int")).alias("date"), (F.col("id") % 5).cast("int").alias("store_id"),
        (F.col("id") % 25).cast("int").alias("product_id"), F.rand(1).alias("product_price"), F.rand(2).alias(tr.TARGET))
    prepared, cores = tr.prepare(rows, ["product_price"], 0.0), spark.sparkContext.defaultParallelism
    gate, fit = threading.Barrier(8, timeout=60), seen.fit

    def together(df):
        gate.wait()  # breaks unless all eight fits are there at once
        fit(df)

    seen.fit = together
    specs = [tr.Spec(n, lambda n, s: seen) for n in "ab"]
    with pytest.raises(tr.TrainingFailed, match="8 of 8 fits failed: a: Seen: ; b: Seen: $"):
        tr.train_all(prepared, specs, folds=3, parallelism=8, every=True)
    assert seen.tasks == [max(1, cores // 8)] * 8
    assert [tr.fit_tasks(n, 1) for n in (0, 300_000, 300_001, 7_500_000)] == [1, 1, 2, 25]
    assert [tr.fit_tasks(n, 40) for n in (0, 300_000, 7_500_000)] == [1, 4, 40]
    assert prepared.at_once(1) == max(tr.PARALLEL_FITS, 2 * cores)
    assert (prepared.share(0), prepared.share(2), prepared.share(1000)) == (cores, cores // 2, 1)


def test_boosting_gets_a_folder_to_cut_its_lineage(spark, monkeypatch):
    named = []
    monkeypatch.setattr(type(spark.sparkContext), "getCheckpointDir", lambda self: named[-1] if named else None)
    monkeypatch.setattr(type(spark.sparkContext), "setCheckpointDir", lambda self, at: named.append(at))
    tr.keep_checkpoints(spark)
    tr.keep_checkpoints(spark)
    assert len(named) == 1 and "/lineage-" in named[0]
