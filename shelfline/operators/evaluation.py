"""Forecast metrics and error analyses over (actual, prediction) rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from shelfline.plans.eda import histogram

LOWER_IS_BETTER = {"rmse", "mae", "mape"}


def metric_columns(label: str = "actual", prediction: str = "prediction", places: int | None = 4) -> dict[str, Column]:
    """The five regression metrics as aggregates over one pass."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    err = p - y
    n = F.count(err)
    sse = F.sum(err * err)
    out = {
        "rmse": F.sqrt(sse / n),
        "mae": F.sum(F.abs(err)) / n,
        "mape": F.avg(F.when(y != 0, F.abs(err / y))) * 100,
        "r2": 1 - F.try_divide(sse, F.var_pop(y) * n),
        "forecast_bias": F.sum(err) / n,
    }
    return out if places is None else {k: F.round(v, places) for k, v in out.items()}


def metrics_regression(df: DataFrame, label: str = "actual", prediction: str = "prediction",
                       by: Sequence[str] = (), places: int | None = 4) -> DataFrame:
    """RMSE, MAE, MAPE (over non-zero actuals, NULL if none), R² and bias, per group of ``by``."""
    return df.groupBy(*by).agg(*[c.alias(k) for k, c in metric_columns(label, prediction, places).items()])


def select_best(metrics: DataFrame, metric: str = "rmse", name: str = "model", order: str = "position") -> DataFrame:
    """The best model by a metric; of equal ones the first in training order.

    Errors are better when lower (the percentage error too), every other metric when higher.
    """
    score = F.col(metric)
    key = F.struct(score if metric in LOWER_IS_BETTER else -score, F.col(order))
    return metrics.where(score.isNotNull()).agg(
        F.min_by(name, key).alias("best_model"), F.min_by(metric, key).alias("best_score"))


def with_errors(df: DataFrame, label: str = "actual", prediction: str = "prediction") -> DataFrame:
    """error = actual - prediction, its size, and its percentage (0 where the actual is 0)."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    return df.withColumns({"error": y - p, "abs_error": F.abs(y - p),
                           "pct_error": F.when(y != 0, F.abs((y - p) / y) * 100).otherwise(0.0)})


def error_by_segment(df: DataFrame, segments: Sequence[str], label: str = "actual", prediction: str = "prediction") -> DataFrame:
    """Mean errors per value of each segment column, stacked in long form from one pass."""
    rows = with_errors(df, label, prediction).select(
        "error", "abs_error", "pct_error",
        F.explode(F.array(*[F.struct(F.lit(s).alias("segment"), F.col(s).cast("string").alias("value")) for s in segments])).alias("s"))
    return rows.groupBy("s.segment", "s.value").agg(
        F.count(F.lit(1)).alias("row_count"), F.round(F.avg("error"), 4).alias("mean_error"),
        F.round(F.avg("abs_error"), 4).alias("mae"), F.round(F.avg("pct_error"), 4).alias("mean_pct_error"))


def residual_stats(df: DataFrame, label: str = "actual", prediction: str = "prediction") -> DataFrame:
    e = with_errors(df, label, prediction)
    return e.agg(F.round(F.avg("error"), 4).alias("mean_residual"), F.round(F.stddev_pop("error"), 4).alias("std_residual"),
                 F.round(F.min("error"), 4).alias("min_residual"), F.round(F.max("error"), 4).alias("max_residual"))


def residual_histogram(df: DataFrame, label: str = "actual", prediction: str = "prediction", bins: int = 50) -> DataFrame:
    return histogram(with_errors(df, label, prediction).select("error"), "error", bins)


def ensemble(predictions: DataFrame, keys: Sequence[str], model: str = "model", label: str = "actual",
             prediction: str = "prediction") -> DataFrame:
    """Simple and inverse-RMSE weighted mean of the models' predictions per row.

    ``predictions`` is long: one row per key and model. The weights are one row per model.
    """
    rmse = metrics_regression(predictions, label, prediction, by=[model], places=None)
    # One entry per model: a map instead of a join keeps the predictions from being shuffled on a few model names.
    weights = rmse.agg(F.map_from_entries(F.collect_list(F.struct(model, 1 / F.col("rmse")))).alias("w")).scalar()
    weighted = predictions.withColumn("w", F.element_at(weights, F.col(model)))
    return weighted.groupBy(*keys).agg(
        F.first(label).alias("actual"), F.avg(prediction).alias("simple"),
        (F.sum(F.col(prediction) * F.col("w")) / F.sum("w")).alias("weighted"))


def ensemble_report(predictions: DataFrame, keys: Sequence[str], model: str = "model", label: str = "actual",
                    prediction: str = "prediction") -> DataFrame:
    """Metrics of both ensembles and their gain over the best single model, in percent."""
    best = metrics_regression(predictions, label, prediction, by=[model], places=None).agg(F.min("rmse").alias("b")).scalar()
    both = ensemble(predictions, keys, model, label, prediction).select("actual", F.expr(
        "stack(2, 'Simple Ensemble', CAST(simple AS DOUBLE), 'Weighted Ensemble', CAST(weighted AS DOUBLE)) AS (model, prediction)"))
    m = metrics_regression(both, by=["model"], places=None).withColumn("best", best)
    return m.select("model", F.round("rmse", 4).alias("rmse"), F.round("mae", 4).alias("mae"), F.round("r2", 4).alias("r2"),
                    F.round((F.col("best") - F.col("rmse")) / F.col("best") * 100, 4).alias("improvement_pct"))


def scaler_stats(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean and population deviation per feature in long form; a constant feature keeps scale 1."""
    row = train.agg(*[F.struct(F.avg(F.col(c).cast("double")).alias("mean"),
                               F.stddev_pop(F.col(c).cast("double")).alias("std")).alias(c) for c in columns])
    long = row.unpivot([], list(columns), "feature", "s")
    return long.select("feature", F.col("s.mean").alias("mean"),
                       F.when(F.col("s.std") == 0, 1.0).otherwise(F.col("s.std")).alias("std"))


def standardize(df: DataFrame, train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """z-scores with the training part's mean and deviation."""
    stats = scaler_stats(train, columns).collect()  # one row per feature
    return df.withColumns({r["feature"]: (F.col(r["feature"]).cast("double") - r["mean"]) / r["std"] for r in stats})


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
