"""Split, training, evaluation, scoring and forecast post-processing."""

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from shelfline.catalog.base import query
from shelfline.catalog.features import TABLE_CTES, TABLE_SELECT, TABLE_VIEWS, feature_table
from shelfline.functions.exprs import clip_round, mean
from shelfline.operators import evaluation as ev
from shelfline.operators.aggregates import daily_sales_agg
from shelfline.operators.split import split_report, time_folds, time_split
from shelfline.plans import forecasts as fc
from shelfline.plans import training as tr
from shelfline.session import fresh_path, materialize

# --- evaluation on two naive forecasts: yesterday's quantity and the quantity 7 rows ago -----------------

NAIVE = """b AS (SELECT date, store_id, product_id, CAST(daily_quantity AS BIGINT) AS actual,
   CAST(LAG(daily_quantity, 1) OVER w AS DOUBLE) AS last, CAST(LAG(daily_quantity, 7) OVER w AS DOUBLE) AS week
  FROM daily WINDOW w AS (PARTITION BY store_id, product_id ORDER BY date)),
 n AS (SELECT * FROM b WHERE week IS NOT NULL)"""
LONG = NAIVE + """, l AS (SELECT date, store_id, product_id, actual, 'last' AS model, last AS prediction FROM n
  UNION ALL SELECT date, store_id, product_id, actual, 'week', week FROM n)"""
METRICS = """ROUND(SQRT(AVG((prediction - actual) * (prediction - actual))), 4) AS rmse, ROUND(AVG(ABS(prediction - actual)), 4) AS mae,
 ROUND(AVG(CASE WHEN actual <> 0 THEN ABS((actual - prediction) / actual) END) * 100, 4) AS mape,
 ROUND(1 - SUM((prediction - actual) * (prediction - actual)) / (VAR_POP(CAST(actual AS DOUBLE)) * COUNT(*)), 4) AS r2,
 ROUND(AVG(prediction - actual), 4) AS forecast_bias"""


def daily(t):
    return daily_sales_agg(t.series_sales).select("date", "store_id", "product_id", "daily_quantity", "daily_revenue")


def naive(t):
    w = W.partitionBy("store_id", "product_id").orderBy("date")
    rows = daily(t).select("date", "store_id", "product_id", F.col("daily_quantity").alias("actual"),
                           F.lag("daily_quantity", 1).over(w).cast("double").alias("last"),
                           F.lag("daily_quantity", 7).over(w).cast("double").alias("week"))
    return rows.dropna(subset=["week"])


def naive_long(t):
    return naive(t).unpivot(["date", "store_id", "product_id", "actual"], ["last", "week"], "model", "prediction")


@query("metrics_regression", "daily", f"WITH {LONG} SELECT model, {METRICS} FROM l GROUP BY model")
def _(t):
    return ev.metrics_regression(naive_long(t), by=["model"])


@query("select_best", "daily", f"""WITH {LONG}, m AS (SELECT model, {METRICS} FROM l GROUP BY model)
 SELECT (SELECT model FROM m ORDER BY rmse, model LIMIT 1) AS best_model, (SELECT MIN(rmse) FROM m) AS best_score""")
def _(t):
    metrics = ev.metrics_regression(naive_long(t), by=["model"]).withColumn("position", F.col("model"))
    return ev.select_best(metrics, "rmse")


@query("error_by_segment", "daily calendar series_stores series_products", f"""WITH {NAIVE}, e AS (SELECT n.*, actual - week AS err, c.day_of_week, c.month, st.region, p.category
   FROM n JOIN calendar c ON n.date = c.date JOIN series_stores st ON n.store_id = st.store_id JOIN series_products p ON n.product_id = p.product_id),
 s AS (SELECT 'day_of_week' AS segment, CAST(day_of_week AS VARCHAR) AS value, err, actual FROM e UNION ALL SELECT 'month', CAST(month AS VARCHAR), err, actual FROM e
  UNION ALL SELECT 'store_region', region, err, actual FROM e UNION ALL SELECT 'product_category', category, err, actual FROM e)
 SELECT segment, value, COUNT(*) AS row_count, ROUND(AVG(err), 4) AS mean_error, ROUND(AVG(ABS(err)), 4) AS mae,
  ROUND(AVG(CASE WHEN actual <> 0 THEN ABS(err / actual) * 100 ELSE 0 END), 4) AS mean_pct_error FROM s GROUP BY 1, 2""")
def _(t):
    from shelfline.operators.features import feat_calendar, feat_product, feat_store
    rows = feat_product(feat_store(feat_calendar(naive(t), t.calendar), t.series_stores), t.series_products)
    return ev.error_by_segment(rows, ["day_of_week", "month", "store_region", "product_category"], prediction="week")


@query("residual_stats", "daily", f"""WITH {NAIVE} SELECT ROUND(AVG(actual - week), 4) AS mean_residual, ROUND(STDDEV_POP(actual - week), 4) AS std_residual,
 ROUND(MIN(actual - week), 4) AS min_residual, ROUND(MAX(actual - week), 4) AS max_residual FROM n""")
def _(t):
    return ev.residual_stats(naive(t), prediction="week")


@query("residual_histogram", "daily", f"""WITH {NAIVE}, e AS (SELECT actual - week AS err FROM n), span AS (SELECT MIN(err) AS lo, MAX(err) AS hi FROM e)
 SELECT LEAST(CAST(FLOOR((err - lo) / (hi - lo) * 50) AS BIGINT) + 1, 50) AS bin, COUNT(*) AS row_count, MIN(err) AS lowest, MAX(err) AS highest FROM e, span GROUP BY 1""")
def _(t):
    return ev.residual_histogram(naive(t), prediction="week")


@query("ensemble", "daily", f"""WITH {LONG}, w AS (SELECT model, 1 / SQRT(AVG((prediction - actual) * (prediction - actual))) AS w FROM l GROUP BY model),
 e AS (SELECT date, store_id, product_id, MAX(actual) AS actual, AVG(prediction) AS simple, SUM(prediction * w) / SUM(w) AS weighted
   FROM l JOIN w ON l.model = w.model GROUP BY 1, 2, 3),
 s AS (SELECT 'Simple Ensemble' AS model, actual, simple AS prediction FROM e UNION ALL SELECT 'Weighted Ensemble', actual, weighted FROM e),
 m AS (SELECT model, SQRT(AVG((prediction - actual) * (prediction - actual))) AS r, AVG(ABS(prediction - actual)) AS a,
   1 - SUM((prediction - actual) * (prediction - actual)) / (VAR_POP(CAST(actual AS DOUBLE)) * COUNT(*)) AS r2 FROM s GROUP BY model)
 SELECT model, ROUND(r, 4) AS rmse, ROUND(a, 4) AS mae, ROUND(r2, 4) AS r2,
  ROUND(((SELECT 1 / MAX(w) FROM w) - r) / (SELECT 1 / MAX(w) FROM w) * 100, 4) AS improvement_pct FROM m""")
def _(t):
    return ev.ensemble_report(materialize(naive_long(t), "predictions"), ["date", "store_id", "product_id"])


# --- split --------------------------------------------------------------------------------------------------

ORDERED = """o AS (SELECT date, store_id, product_id, CAST(daily_quantity AS DOUBLE) AS q, CAST(daily_revenue AS DOUBLE) AS r,
  row_number() OVER (ORDER BY date, store_id, product_id) - 1 AS i, COUNT(*) OVER () AS n FROM daily)"""


@query("time_split", "daily", f"""WITH {ORDERED} SELECT date, CAST(store_id AS BIGINT) AS store_id, CAST(product_id AS BIGINT) AS product_id,
 i < CAST(FLOOR(n * 0.8) AS BIGINT) AS is_train FROM o""")
def _(t):
    rows = materialize(daily(t).select("date", "store_id", "product_id"), "daily")
    train, test = time_split(rows)
    return train.withColumn("is_train", F.lit(True)).unionByName(test.withColumn("is_train", F.lit(False)))


@query("time_split_report", "daily", f"""WITH {ORDERED} SELECT CASE WHEN i < FLOOR(n * 0.8) THEN 'train' ELSE 'test' END AS part, COUNT(*) AS row_count,
 MIN(date) AS first_date, MAX(date) AS last_date FROM o GROUP BY 1""")
def _(t):
    return split_report(*time_split(materialize(daily(t).select("date", "store_id", "product_id"), "daily")))


@query("time_folds", "daily", f"""WITH {ORDERED} SELECT date, CAST(store_id AS BIGINT) AS store_id, CAST(product_id AS BIGINT) AS product_id,
 CAST(CASE WHEN i < n // 3 + CAST(n % 3 > 0 AS INT) THEN 0 WHEN i < 2 * (n // 3) + LEAST(n % 3, 2) THEN 1 ELSE 2 END AS BIGINT) AS fold FROM o""")
def _(t):
    return time_folds(materialize(daily(t).select("date", "store_id", "product_id"), "daily"), 3)


@query("standardize", "daily", f"""WITH {ORDERED}, s AS (SELECT AVG(q) AS mq, STDDEV_POP(q) AS sq, AVG(r) AS mr, STDDEV_POP(r) AS sr FROM o WHERE i < FLOOR(n * 0.8))
 SELECT date, CAST(store_id AS BIGINT) AS store_id, CAST(product_id AS BIGINT) AS product_id, ROUND((q - mq) / sq, 6) AS daily_quantity, ROUND((r - mr) / sr, 6) AS daily_revenue FROM o, s""")
def _(t):
    rows = materialize(daily(t), "daily")
    cols = ["daily_quantity", "daily_revenue"]
    scaled = ev.standardize(rows, time_split(rows)[0], cols)
    return scaled.select("date", "store_id", "product_id", *[F.round(c, 6).alias(c) for c in cols])


# --- training -------------------------------------------------------------------------------------------------

KEEP = ["day_of_week", "month"]


def features_of(t):
    return materialize(feature_table(t), "features")


def prepared_of(t, features=None):
    """Split, encoded and scaled feature rows; models of equal rows come from the store, whichever query made them."""
    return tr.prepare(features_of(t) if features is None else features, keep=KEEP)


def specs(*names):
    return [s for s in tr.model_specs() if s.name in names]


# --- linear models on all features: the comparison solves the normal equations by elimination, as a recursive query
# over the sums of products; lasso, which has no such form, is compared on one feature and tested on all ----------

K = len(tr.FEATURES)


def _encoded(name, places=None):
    if places is not None and name.startswith("rolling_std"):
        return f"ROUND(COALESCE({name}, 0), {places}) AS {name}"
    kind = "INTEGER" if name in ("is_weekend", "is_holiday", "is_perishable", "has_promotion") else "DOUBLE"
    return f"COALESCE(CAST(CAST({name} AS {kind}) AS DOUBLE), 0) AS {name}"


# Rows in time order with their part (-1: test, else the fold of three) and features scaled by the training part.
SCALED_SQL = f"""{TABLE_CTES}, t AS ({TABLE_SELECT}),
 e AS (SELECT date, store_id, product_id, CAST(daily_quantity AS DOUBLE) AS y, row_number() OVER (ORDER BY date, store_id, product_id) - 1 AS i,
   COUNT(*) OVER () AS n, {', '.join(_encoded(n) for n in tr.FEATURES)} FROM t),
 p AS (SELECT *, CAST(FLOOR(n * 0.8) AS BIGINT) AS k FROM e),
 f AS (SELECT i, y, date, store_id, product_id, CASE WHEN i >= k THEN -1 WHEN i < k // 3 + CAST(k % 3 > 0 AS INT) THEN 0 WHEN i < 2 * (k // 3) + LEAST(k % 3, 2) THEN 1 ELSE 2 END AS fold,
   [{', '.join(tr.FEATURES)}] AS x FROM p),
 c AS (SELECT unnest(range(1, {K + 1})) AS nr),
 s AS (SELECT nr, AVG(x[nr]) AS m, STDDEV_SAMP(x[nr]) AS s FROM f, c WHERE fold >= 0 GROUP BY nr),
 sl AS (SELECT list(m ORDER BY nr) AS m, list(s ORDER BY nr) AS s FROM s),
 z AS (SELECT f.*, list_transform(list_zip(x, m, s), lambda v: CASE WHEN v[3] > 0 THEN (v[1] - v[2]) / v[3] ELSE 0 END) AS z FROM f, sl)"""
# For each set of training folds (3: all, 0 to 2: all but that one): centred sums of products with features and target.
GRAM_SQL = f"""o AS (SELECT unnest([0, 1, 2, 3]) AS left_out),
 q AS (SELECT left_out, z.* FROM z JOIN o ON fold >= 0 AND fold <> left_out),
 mean AS (SELECT left_out, nr, AVG(z[nr]) AS m, AVG(y) AS my, COUNT(*) AS n FROM q, c GROUP BY 1, 2),
 prod AS (SELECT left_out, a.nr AS i, b.nr AS j, SUM(z[a.nr] * z[b.nr]) AS v FROM q, c a, c b GROUP BY 1, 2, 3),
 cross_y AS (SELECT left_out, c.nr AS i, SUM(z[c.nr] * (y - my)) AS v FROM q JOIN mean USING (left_out), c WHERE mean.nr = 1 GROUP BY 1, 2),
 gram AS (SELECT p.left_out, i, j, v - a.n * a.m * b.m AS v FROM prod p JOIN mean a ON p.left_out = a.left_out AND i = a.nr JOIN mean b ON p.left_out = b.left_out AND j = b.nr)"""
SOLVE_SQL = f"""kind AS (SELECT * FROM (VALUES ('LinearRegression', 0.0::DOUBLE), ('Ridge', 1.0::DOUBLE)) AS v(model, alpha)),
 m0 AS (SELECT model, left_out, i, j, v + CASE WHEN i = j THEN alpha ELSE 0 END AS v FROM gram, kind
   UNION ALL SELECT model, left_out, i, {K + 1}, v FROM cross_y, kind),
 least AS (SELECT model, left_out, i, v * 1e-9::DOUBLE AS v FROM m0 WHERE i = j),
 w AS (SELECT 0 AS step, * FROM m0 UNION ALL
   SELECT a.step + 1, a.model, a.left_out, a.i, a.j, CASE
     WHEN p.v <= l.v THEN CASE WHEN a.i = a.step + 1 OR a.j = a.step + 1 THEN 0 ELSE a.v END
     WHEN a.i = a.step + 1 THEN a.v / p.v ELSE a.v - q.v * r.v / p.v END
   FROM w a JOIN w p ON p.model = a.model AND p.left_out = a.left_out AND p.i = a.step + 1 AND p.j = a.step + 1
    JOIN w q ON q.model = a.model AND q.left_out = a.left_out AND q.i = a.i AND q.j = a.step + 1
    JOIN w r ON r.model = a.model AND r.left_out = a.left_out AND r.i = a.step + 1 AND r.j = a.j
    JOIN least l ON l.model = a.model AND l.left_out = a.left_out AND l.i = a.step + 1
   WHERE a.step < {K}),
 coef AS (SELECT model, left_out, i AS nr, v AS b FROM w WHERE step = {K} AND j = {K + 1})"""
FITTED_SQL = """fitted AS (SELECT coef.model, coef.left_out, list(b ORDER BY coef.nr) AS b, MAX(my) - SUM(b * m) AS a FROM coef JOIN mean ON coef.left_out = mean.left_out AND coef.nr = mean.nr GROUP BY 1, 2)"""
NAMES_SQL = f"[{', '.join(repr(n) for n in tr.FEATURES)}]"


def linear_sql(solve, model):
    return f"""WITH RECURSIVE {SCALED_SQL}, {GRAM_SQL}, {solve}, {FITTED_SQL},
 gap AS (SELECT fold >= 0 AS training, y - a - list_dot_product(z, b) AS e FROM z, fitted WHERE model = '{model}' AND left_out = 3),
 r AS (SELECT ROUND(SQRT(AVG(e * e) FILTER (training)), 3) AS train_rmse, ROUND(SQRT(AVG(e * e) FILTER (NOT training)), 3) AS test_rmse,
   COUNT(*) FILTER (training) AS train_rows, COUNT(*) FILTER (NOT training) AS test_rows FROM gap)
 SELECT model, {NAMES_SQL}[nr] AS feature, ROUND(b[nr], 3) AS coefficient, ROUND(a, 3) AS intercept, r.* FROM fitted, c, r WHERE model = '{model}' AND left_out = 3"""


def _linear_query(name, model, views="", sql=None, names=tr.FEATURES):
    @query(name, views, sql)
    def _(t):
        prepared = tr.prepare(features_of(t), names)
        parts = prepared.grams(tr.CV_FOLDS)
        train, test = tr.Gram.total(g for k, g in parts.items() if k >= 0), parts[-1]
        fit = tr.linear_models(tr.RIDGE_ALPHA, tr.LASSO_ALPHA)[model](train)
        rows = [(model, n, round(float(b), 3) + 0.0, round(fit.intercept, 3), round(train.rmse(fit), 3), round(test.rmse(fit), 3), train.rows, test.rows)
                for n, b in zip(prepared.names, fit.coefficients)]
        return t.spark.createDataFrame(rows, "model STRING, feature STRING, coefficient DOUBLE, intercept DOUBLE, train_rmse DOUBLE, test_rmse DOUBLE, train_rows BIGINT, test_rows BIGINT")


ONE_FEATURE = "sales_lag_7"
ONE_SQL = f"""WITH x AS (SELECT y, r, row_number() OVER (ORDER BY date, store_id, product_id) - 1 AS j, COUNT(*) OVER () AS m FROM (
   SELECT date, store_id, product_id, CAST(daily_quantity AS DOUBLE) AS y,
     CAST(LAG(daily_revenue, 7) OVER (PARTITION BY store_id, product_id ORDER BY date) AS DOUBLE) AS r FROM daily) WHERE r IS NOT NULL),
 part AS (SELECT *, j < CAST(FLOOR(m * 0.8) AS BIGINT) AS training FROM x),
 fitted AS (SELECT COUNT(*) AS k, AVG(y) AS my, AVG(r) AS mx, STDDEV_SAMP(r) AS sx, COVAR_POP(y, r) * COUNT(*) / STDDEV_SAMP(r) AS sxy FROM part WHERE training),
 coef AS (SELECT *, SIGN(sxy) * GREATEST(ABS(sxy) / k - 0.1, 0) / ((k - 1.0) / k) AS b FROM fitted),
 gap AS (SELECT training, y - (my + b * (r - mx) / sx) AS e FROM part, coef)
 SELECT 'Lasso' AS model, '{ONE_FEATURE}' AS feature, (SELECT ROUND(b, 3) FROM coef) AS coefficient, (SELECT ROUND(my, 3) FROM coef) AS intercept,
  ROUND(SQRT(AVG(e * e) FILTER (training)), 3) AS train_rmse, ROUND(SQRT(AVG(e * e) FILTER (NOT training)), 3) AS test_rmse,
  COUNT(*) FILTER (training) AS train_rows, COUNT(*) FILTER (NOT training) AS test_rows FROM gap"""

_linear_query("train_linear", "LinearRegression", TABLE_VIEWS, linear_sql(SOLVE_SQL, "LinearRegression"))
_linear_query("train_ridge", "Ridge", TABLE_VIEWS, linear_sql(SOLVE_SQL, "Ridge"))
_linear_query("train_lasso", "Lasso")
_linear_query("train_lasso_single", "Lasso", "daily", ONE_SQL, [ONE_FEATURE])


def _training_query(name, *models):
    @query(name)
    def _(t):
        return tr.results_summary(t.spark, tr.train_all(prepared_of(t), specs(*models), folds=0, every=True))


_training_query("train_random_forest", "RandomForest")
_training_query("train_gbt", "BoostedDepthwise", "BoostedLeafy", "BoostedSampled")


@query("encode_features", TABLE_VIEWS, f"""WITH {TABLE_CTES}, t AS ({TABLE_SELECT})
 SELECT date, store_id, product_id, {', '.join(_encoded(n, 4) for n in tr.FEATURES)} FROM t""")
def _(t):
    rows, used, _ = tr.encode_features(features_of(t))
    stds = [n for n in used if n.startswith("rolling_std")]
    return rows.select("date", "store_id", "product_id", *used).withColumns({n: F.round(n, 4) for n in stds})


@query("cross_validate", TABLE_VIEWS, f"""WITH RECURSIVE {SCALED_SQL}, {GRAM_SQL}, {SOLVE_SQL}, {FITTED_SQL},
  score AS (SELECT model, left_out, SQRT(AVG((y - a - list_dot_product(z, b)) * (y - a - list_dot_product(z, b)))) AS rmse FROM z JOIN fitted ON fold = left_out GROUP BY 1, 2)
  SELECT model, ROUND(AVG(rmse), 3) AS cv_rmse, ROUND(STDDEV_POP(rmse), 3) AS cv_std, COUNT(*) AS folds FROM score GROUP BY model""")
def _(t):
    found = tr.fold_rmse(specs("LinearRegression", "Ridge"), prepared_of(t), tr.CV_FOLDS)
    rows = [(name, *[round(v, 3) for v in tr._mean_std(scores)], len(scores)) for name, scores in found.items()]
    return t.spark.createDataFrame(rows, "model STRING, cv_rmse DOUBLE, cv_std DOUBLE, folds BIGINT")


@query("train_all")
def _(t):
    return tr.metrics_frame(t.spark, tr.train_all(prepared_of(t), folds=0, every=True))


@query("results_summary")
def _(t):
    return tr.results_summary(t.spark, tr.train_all(prepared_of(t), every=True))


@query("save_load_models", TABLE_VIEWS, f"""WITH {TABLE_CTES}, t AS ({TABLE_SELECT})
  SELECT date, store_id, product_id, TRUE AS same, CAST(7 AS BIGINT) AS models FROM t""")
def _(t):
    # Stored, loaded again and applied to every row: the reloaded best model predicts what the fitted one does.
    features, path = features_of(t), fresh_path(t.spark, "models")
    prepared = prepared_of(t, features)
    results = tr.train_all(prepared, folds=0, every=True)
    best = tr.best_of(t.spark, results)
    tr.save_models(t.spark, results, path, best.name, prepared.names)
    _, model, names = tr.load_best(t.spark, path)
    rows = tr.encode_features(features, names)[0].select("date", "store_id", "product_id", *names)
    drop = ["raw_features", "features"]
    both = model.transform(best.model.transform(rows).withColumnRenamed("prediction", "fitted").drop(*drop))
    return both.select("date", "store_id", "product_id", (F.col("prediction") == F.col("fitted")).alias("same"), F.lit(len(results)).alias("models"))


@query("train_job")
def _(t):
    features = features_of(t)
    prepared = prepared_of(t, features)
    out = tr.training_job(t.spark, t.series_sales, t.calendar, t.series_stores, t.series_products, t.series_weather,
                          t.series_promotions, save_features=True, done=(features, prepared, tr.train_all(prepared, every=True)))
    keys = ["feature_rows", "features", "models_trained", "best_model", "best_rmse", "train_rows", "test_rows"]
    return t.spark.createDataFrame([tuple(out[k] for k in keys)],
                                   "feature_rows BIGINT, features INT, models_trained INT, best_model STRING, best_rmse DOUBLE, train_rows BIGINT, test_rows BIGINT")


def importance_of(t):
    prepared = prepared_of(t)
    trees = specs("RandomForest", "BoostedDepthwise", "BoostedLeafy", "BoostedSampled")
    results = tr.train_all(prepared, trees, folds=0, every=True)
    return [r.name for r in results], tr.feature_importance(t.spark, results, prepared.names)


@query("feature_importance")
def _(t):
    return tr.top_features(importance_of(t)[1])


@query("feature_importance_by_model")
def _(t):
    trees, importance = importance_of(t)
    return tr.importance_by_model(importance, trees)


@query("learning_curve")
def _(t):
    prepared = prepared_of(t)
    best = tr.best_of(t.spark, tr.train_all(prepared, folds=0, every=True))
    return tr.learning_curve(t.spark, specs(best.name)[0], prepared)


@query("learning_curve_linear")
def _(t):
    return tr.learning_curve(t.spark, specs("Ridge")[0], prepared_of(t))


@query("cv_report")
def _(t):
    return tr.cv_report(t.spark, tr.model_specs(), prepared_of(t))


# --- scoring and forecasts ----------------------------------------------------------------------------------------


def requests_of(features):
    """Known series, unknown ones (default vector), and features given by the caller: two that differ in the price only."""
    horizon = F.element_at(F.array(*[F.lit(h) for h in fc.HORIZONS]), (F.col("product_id") % 3 + 1).cast("int"))
    series = features.select("store_id", "product_id").distinct()

    def shifted(by, given):
        return series.withColumn("product_id", F.col("product_id") + by).withColumn("horizon", horizon).withColumn("given", given)

    none = F.lit(None).cast("map<string,double>")
    out = shifted(0, none).unionByName(shifted(1000, none))
    for by, price in ((2000, 5.0), (3000, 9.0)):
        out = out.unionByName(shifted(by, F.create_map(F.lit("product_price"), F.lit(price), F.lit("qty_lag_7"), F.lit(25.0))))
    return out


DEFAULT_LIST = ", ".join(str(float(fc.DEFAULT_FEATURES[n])) for n in tr.FEATURES)
GIVEN_LIST = ", ".join({"product_price": "price", "qty_lag_7": "25.0::DOUBLE"}.get(n, "0.0::DOUBLE") for n in tr.FEATURES)


@query("score_batch", TABLE_VIEWS, f"""WITH RECURSIVE {SCALED_SQL}, {GRAM_SQL}, {SOLVE_SQL}, {FITTED_SQL},
  l AS (SELECT store_id, product_id, arg_max(x, date) AS x FROM f GROUP BY 1, 2),
  a AS (SELECT store_id, product_id, x, TRUE AS has_history FROM l UNION ALL SELECT store_id, product_id + 1000, [{DEFAULT_LIST}], FALSE FROM l
   UNION ALL SELECT store_id, product_id + shift, [{GIVEN_LIST}], FALSE FROM l, (VALUES (2000, 5.0::DOUBLE), (3000, 9.0::DOUBLE)) AS v(shift, price)),
  u AS (SELECT a.*, list_transform(list_zip(x, m, s), lambda v: CASE WHEN v[3] > 0 THEN (v[1] - v[2]) / v[3] ELSE 0 END) AS z FROM a, sl)
  SELECT store_id, product_id, CAST([7, 14, 30][product_id % 3 + 1] AS BIGINT) AS horizon_days,
   ROUND(GREATEST(fitted.a + list_dot_product(z, b), 0), 2) AS predicted_quantity, 'Ridge' AS model_used, has_history, CAST(NULL AS VARCHAR) AS error
  FROM u, fitted WHERE model = 'Ridge' AND left_out = 3""")
def _(t):
    # The ridge model on all features as one expression over the unscaled columns.
    features = features_of(t)
    prepared = prepared_of(t, features)
    train = tr.Gram.total(g for k, g in prepared.grams(tr.CV_FOLDS).items() if k >= 0)
    scaler = prepared.stages.stages[-1]
    formula = tr.as_column(tr.linear_models(tr.RIDGE_ALPHA, tr.LASSO_ALPHA)["Ridge"](train), prepared.names, scaler.mean, scaler.std)
    return fc.score_batch(requests_of(features), features, formula, "Ridge", prepared.names, given="given")


@query("score_batch_best")
def _(t):
    features = features_of(t)
    prepared = prepared_of(t, features)
    best = tr.best_of(t.spark, tr.train_all(prepared, folds=0, every=True))
    return fc.score_batch(requests_of(features), features, best.model, best.name, prepared.names, given="given")


DEFAULT_SQL = ", ".join(f"CAST({float(v)} AS DOUBLE) AS {k}" for k, v in fc.DEFAULT_FEATURES.items())


@query("default_features", "stores", f"SELECT store_id, {DEFAULT_SQL} FROM stores")
def _(t):
    return fc.default_features(t.stores.select("store_id"))


@query("validate_requests", "stores products", """SELECT o_orderkey AS request_id, o_custkey AS store_id, o_orderkey AS product_id,
  CAST([7, 14, 30, 10][o_orderkey % 4 + 1] AS BIGINT) AS horizon,
  CASE WHEN NOT o_custkey BETWEEN (SELECT MIN(store_id) FROM stores) AND (SELECT MAX(store_id) FROM stores) THEN 'invalid store_id'
   WHEN NOT o_orderkey BETWEEN (SELECT MIN(product_id) FROM products) AND (SELECT MAX(product_id) FROM products) THEN 'invalid product_id'
   WHEN o_orderkey % 4 = 3 THEN 'invalid horizon' END AS reason FROM orders""")
def _(t):
    horizon = F.element_at(F.array(*[F.lit(h) for h in (7, 14, 30, 10)]), (F.col("o_orderkey") % 4 + 1).cast("int"))
    requests = t.raw("orders").select(F.col("o_orderkey").alias("request_id"), F.col("o_custkey").alias("store_id"),
                                      F.col("o_orderkey").alias("product_id"), horizon.alias("horizon"))
    return fc.validate_requests(requests, t.stores, t.products)


BASE = """base AS (SELECT store_id, product_id, CAST([7, 14, 30][product_id % 3 + 1] AS INTEGER) AS horizon_days, MAX(date) AS forecast_date,
  ROUND(CAST(SUM(daily_quantity) AS DOUBLE) / COUNT(*), 2) AS q FROM daily GROUP BY 1, 2)"""
CURVE = BASE + """, steps AS (SELECT *, unnest(range(1, horizon_days + 1)) AS step FROM base),
 v AS (SELECT store_id, product_id, horizon_days, forecast_date, forecast_date + CAST(step AS INTEGER) AS target_date,
   FLOOR(q + (step - 1) * 0.1::DOUBLE + CASE WHEN isodow(forecast_date + CAST(step AS INTEGER)) >= 6 THEN q * 0.1::DOUBLE ELSE 0 END + 0.5::DOUBLE) AS value FROM steps),
 curve AS (SELECT *, FLOOR(value * (1 - 0.15::DOUBLE) + 0.5::DOUBLE) AS lower_bound, FLOOR(value * (1 + 0.15::DOUBLE) + 0.5::DOUBLE) AS upper_bound FROM v)"""


def scored(t):
    """Mean quantity of the series as its forecast."""
    horizon = F.element_at(F.array(*[F.lit(h) for h in fc.HORIZONS]), (F.col("product_id") % 3 + 1).cast("int"))
    return daily(t).groupBy("store_id", "product_id").agg(
        F.max("date").alias("forecast_date"), clip_round(mean("daily_quantity")).alias("predicted_quantity"),
    ).withColumn("horizon_days", horizon)


@query("forecast_expand", "daily", f"""WITH {CURVE} SELECT CAST(store_id AS BIGINT) AS store_id, CAST(product_id AS BIGINT) AS product_id, CAST(horizon_days AS BIGINT) AS horizon_days,
 forecast_date, target_date, CAST(value AS BIGINT) AS value, CAST(lower_bound AS BIGINT) AS lower_bound, CAST(upper_bound AS BIGINT) AS upper_bound FROM curve""")
def _(t):
    return fc.forecast_expand(scored(t))


@query("forecast_insights", "daily", f"""WITH {CURVE}, g AS (SELECT store_id, product_id, horizon_days, SUM(value) AS total, MIN(value) AS lo, MAX(value) AS hi, SUM(value) / COUNT(*) AS a FROM curve GROUP BY 1, 2, 3),
 k AS (SELECT c.store_id, c.product_id, string_agg(CAST(target_date AS VARCHAR), ',' ORDER BY target_date) AS peaks FROM curve c JOIN g ON c.store_id = g.store_id AND c.product_id = g.product_id
   WHERE value >= a * 1.05::DOUBLE GROUP BY 1, 2)
 SELECT CAST(g.store_id AS BIGINT) AS store_id, CAST(g.product_id AS BIGINT) AS product_id, CAST(horizon_days AS BIGINT) AS horizon_days, ROUND(a, 4) AS avg_demand, CAST(total AS BIGINT) AS total_forecast,
  CAST(lo AS BIGINT) AS min_value, CAST(hi AS BIGINT) AS max_value, ROUND((hi - lo) / a * 100, 1) AS variability_pct, COALESCE(peaks, '') AS peak_days,
  CAST(FLOOR(hi * 0.15::DOUBLE + 0.5::DOUBLE) AS BIGINT) AS safety_stock, CAST(total + FLOOR(hi * 0.15::DOUBLE + 0.5::DOUBLE) * horizon_days AS BIGINT) AS total_inventory,
  ROUND((hi - lo) / a * 100, 1) > 20 AS high_variability
 FROM g LEFT JOIN k ON g.store_id = k.store_id AND g.product_id = k.product_id""")
def _(t):
    return fc.forecast_insights(fc.forecast_expand(scored(t)))


STORED = """SELECT forecast_date, target_date, CAST(store_id AS BIGINT) AS store_id, CAST(product_id AS BIGINT) AS product_id,
  'mean' AS model_name, value AS predicted_quantity FROM curve"""


@query("forecast_store", "daily", f"""WITH {CURVE} SELECT *, '2.0' AS model_version FROM ({STORED})""")
def _(t):
    curve = materialize(fc.forecast_expand(scored(t)), "curve")
    old = fc.forecast_rows(curve.withColumn("value", F.col("value") + 5).where(F.weekday("target_date") < 5), "mean", "1.0")
    stored = fc.forecast_store(old, fc.forecast_rows(curve, "mean", "2.0"))
    return stored.select("forecast_date", "target_date", "store_id", "product_id", "model_name", "predicted_quantity", "model_version")


@query("forecast_backfill", "daily", f"""WITH {CURVE}, f AS (SELECT store_id, product_id, forecast_date - 400 AS forecast_date, target_date - 400 AS target_date, value FROM curve)
 SELECT f.target_date, CAST(f.store_id AS BIGINT) AS store_id, CAST(f.product_id AS BIGINT) AS product_id, value AS predicted_quantity,
  CAST(d.daily_quantity AS BIGINT) AS actual_quantity, CAST(d.daily_revenue AS DOUBLE) AS actual_revenue, ABS(d.daily_quantity - value) AS absolute_error,
  ROUND(ABS(d.daily_quantity - value) / NULLIF(d.daily_quantity, 0) * 100, 4) AS percentage_error
 FROM f LEFT JOIN daily d ON f.target_date = d.date AND f.store_id = d.store_id AND f.product_id = d.product_id""")
def _(t):
    curve = fc.forecast_expand(scored(t)).withColumns({
        "forecast_date": F.date_sub("forecast_date", 400), "target_date": F.date_sub("target_date", 400)})
    filled = fc.forecast_backfill(fc.forecast_rows(curve, "mean"), daily(t))
    return filled.select("target_date", "store_id", "product_id", "predicted_quantity", "actual_quantity", "actual_revenue",
                         "absolute_error", "percentage_error")
