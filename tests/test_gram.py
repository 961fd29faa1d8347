"""Linear models from sums of products, and the store of fitted models."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F
from retail_rows import day

from shelfline.operators import gram as G
from shelfline.plans import training as tr
from shelfline.sources.model_store import ModelStore, fingerprint


def rows_of(n=400, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4)) * [1, 40, 0.1, 3] + [0, 2000, 5, -1]
    x = np.column_stack([x, 2 * x[:, 1] - 7])  # the last one is aliased
    return x, x @ [1.5, 0.02, -8, 0, 0] + rng.normal(size=n), rng.integers(0, 5, n)


@pytest.fixture(scope="module")
def parts(spark):
    x, y, part = rows_of()
    df = spark.createDataFrame([(int(p), [float(v) for v in r], float(t)) for p, r, t in zip(part, x, y)], "part INT, x ARRAY<DOUBLE>, y DOUBLE")
    return G.gram_parts(df.repartition(7), "part", "x", "y", 5)


def test_sums_of_parts_are_the_sums_of_their_rows(parts):
    x, y, part = rows_of()
    assert sorted(parts) == [0, 1, 2, 3, 4] and [parts[k].rows for k in range(5)] == np.bincount(part).tolist()
    a = np.column_stack([np.ones(len(y)), x, y])
    some = np.isin(part, [1, 4])
    assert G.Gram.total([parts[1], parts[4]]).m == pytest.approx(a[some].T @ a[some], rel=1e-12)
    assert (parts[1] + parts[4]).rows == some.sum()


def test_least_squares_and_ridge(parts):
    x, y, part = rows_of()
    g = G.Gram.total(parts.values())
    fit = G.least_squares(g)
    assert fit.coefficients[4] == 0  # aliased with the second
    best = np.linalg.lstsq(np.column_stack([np.ones(len(y)), x[:, :4]]), y, rcond=None)[0]
    assert fit.intercept == pytest.approx(best[0], rel=1e-6) and fit.coefficients[:4] == pytest.approx(best[1:], rel=1e-6)
    gap = y - fit.intercept - x @ fit.coefficients
    assert g.rmse(fit) == pytest.approx(np.sqrt((gap**2).mean()), rel=1e-6)
    ridge = G.least_squares(g, "Ridge", 10.0)
    c = x - x.mean(0)
    assert ridge.coefficients == pytest.approx(np.linalg.solve(c.T @ c + 10 * np.eye(5), c.T @ (y - y.mean())), rel=1e-5)
    scores = G.fold_scores(parts, G.least_squares, range(5))
    for k in range(5):
        own, others = part == k, part != k
        b = np.linalg.lstsq(np.column_stack([np.ones(others.sum()), x[others, :4]]), y[others], rcond=None)[0]
        gap = y[own] - b[0] - x[own, :4] @ b[1:]
        assert scores[k] == pytest.approx(np.sqrt((gap**2).mean()), rel=1e-6)


@pytest.mark.parametrize("alpha", [0.001, 0.1, 1.0, 100.0])
def test_lasso_meets_its_optimality_conditions(alpha):
    x, y, _ = rows_of()
    z = (x[:, :4] - x[:, :4].mean(0)) / x[:, :4].std(0)
    a = np.column_stack([np.ones(len(y)), z, y])
    fit = G.lasso(G.Gram(a.T @ a), alpha)
    slope = z.T @ (y - fit.intercept - z @ fit.coefficients) / len(y)
    for s, b in zip(slope, fit.coefficients):
        assert abs(s) <= alpha + 1e-8 if b == 0 else s == pytest.approx(alpha * np.sign(b), abs=1e-8)
    assert (fit.coefficients != 0).sum() == {0.001: 4, 0.1: 3, 1.0: 1, 100.0: 0}[alpha]


def test_model_as_an_expression(spark, parts):
    fit = G.LinearFit("x", 2.0, np.array([3.0, 0.0, -1.0]))
    df = spark.createDataFrame([(1.0, 5.0, 4.0), (2.0, 6.0, 8.0)], "a DOUBLE, b DOUBLE, c DOUBLE")
    got = [r.p for r in df.select(G.as_column(fit, ["a", "b", "c"], [1.0, 0.0, 4.0], [2.0, 1.0, 4.0]).alias("p")).collect()]
    assert got == [2.0, 2.0 + 1.5 - 1.0]


def training_rows(spark, n=300):
    x, y, _ = rows_of(n)
    rows = [(day("2024-01-01") if i < n // 2 else day("2024-02-01"), i % 7, i, *[float(v) for v in r[:3]], float(t)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, f"date DATE, store_id INT, product_id INT, a DOUBLE, b DOUBLE, c DOUBLE, {tr.TARGET} DOUBLE")


def test_models_of_equal_rows_are_fitted_once(spark, monkeypatch):
    df = training_rows(spark)
    fits = []
    from pyspark.ml.regression import DecisionTreeRegressor

    def make(depth):
        def spec(n, s):
            est = DecisionTreeRegressor(labelCol=tr.TARGET, featuresCol="features", maxDepth=depth)
            fit = est.fit
            est.fit = lambda d: fits.append(depth) or fit(d)
            return est
        return tr.Spec("Tree", spec)

    first = tr.train_all(tr.prepare(df, ["a", "b", "c"]), [make(2)], folds=3)
    assert len(fits) == 4
    second = tr.train_all(tr.prepare(df.orderBy("product_id").repartition(3), ["a", "b", "c"]), [make(2)], folds=3)
    assert len(fits) == 4 and (first[0].test_metrics, first[0].cv_rmse) == (second[0].test_metrics, second[0].cv_rmse)
    rows = tr.encode_features(df, ["a", "b", "c"])[0]
    sums = [r.model.transform(rows).agg(F.sum("prediction")).first()[0] for r in (first[0], second[0])]
    assert sums[0] == sums[1]
    tr.train_all(tr.prepare(df, ["a", "b", "c"]), [make(3)], folds=0)  # other parameters
    tr.train_all(tr.prepare(df.withColumn("a", F.col("a") + 1), ["a", "b", "c"]), [make(3)], folds=0)  # other rows
    assert len(fits) == 6


def test_artefact_counts_once_it_is_complete(spark, tmp_path):
    store = ModelStore(spark, "data", str(tmp_path))
    calls = []

    def lost():
        calls.append("lost")
        raise RuntimeError("driver lost")

    for _ in range(2):
        with pytest.raises(RuntimeError):
            store.value({"k": 1}, lost)
    assert len(calls) == 2
    assert store.value({"k": 1}, lambda: [1.5, None]) == [1.5, None] == store.value({"k": 1}, lost)
    assert store.value({"k": 2}, lambda: "other") == "other"
    df = training_rows(spark)
    fitted = tr.prepare(df, ["a"]).stages

    def half():
        fitted.write().overwrite().save(f"{store._path({'k': 3})}/model")
        raise RuntimeError("lost before the scores were written")

    with pytest.raises(RuntimeError):
        store.model({"k": 3}, half)
    model, scores = store.model({"k": 3}, lambda: (fitted, {"rmse": 1.0}))
    assert isinstance(model, PipelineModel) and scores == {"rmse": 1.0}


def test_fingerprint_is_of_the_rows(spark):
    df = training_rows(spark)
    assert fingerprint(df) == fingerprint(df.repartition(5).orderBy("product_id"))
    assert fingerprint(df) != fingerprint(df.where("product_id > 0")) and fingerprint(df) != fingerprint(df.withColumnRenamed("a", "z"))
    assert fingerprint(df) == fingerprint(df.withColumn("a", F.col("a") + 1e-9))


def test_learning_curve_of_a_linear_model_is_one_pass(spark):
    prepared = tr.prepare(training_rows(spark, 1000), ["a", "b", "c"])
    ridge = next(s for s in tr.model_specs() if s.name == "Ridge")
    rows = tr.learning_curve(spark, ridge, prepared, folds=4).collect()
    assert [r.share for r in rows] == [i / 10 for i in range(1, 11)]
    assert [r.train_rows for r in rows] == sorted(r.train_rows for r in rows) and rows[-1].train_rows == 600
    mean, std, scores = tr.cross_validate(ridge, prepared, 4)
    assert rows[-1].val_rmse == pytest.approx(mean) and rows[-1].val_std == pytest.approx(std) and len(scores) == 4
