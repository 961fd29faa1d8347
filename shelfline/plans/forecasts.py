"""Batch scoring and what follows from a forecast: daily curve, inventory figures, storage, actuals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions.exprs import clip_round, ratio
from shelfline.operators.features import FEATURES
from shelfline.plans.incremental import upsert

HORIZONS = (7, 14, 30)
FORECAST_KEYS = ["forecast_date", "target_date", "store_id", "product_id", "model_name"]

# Features assumed for a series without history.
DEFAULT_FEATURES = {
    "sales_lag_7": 100, "sales_lag_14": 95, "sales_lag_30": 90,
    "qty_lag_7": 50, "qty_lag_14": 48, "qty_lag_30": 45,
    "rolling_mean_7": 100, "rolling_std_7": 15,
    "rolling_mean_14": 98, "rolling_std_14": 18,
    "rolling_mean_30": 95, "rolling_std_30": 20,
    "rolling_min_7": 70, "rolling_max_7": 130,
    "day_of_week": 3, "week_of_year": 25, "month": 6, "quarter": 2,
    "is_weekend": False, "is_holiday": False, "days_to_holiday": 30,
    "store_size_sqft": 50000, "product_price": 5.0, "is_perishable": False,
    "temp_high_f": 75, "temp_low_f": 55, "precipitation_inches": 0,
    "has_promotion": False, "promotion_discount": 0,
    "store_avg_daily_sales_30d": 5000, "product_avg_daily_sales_30d": 500,
}


def default_features(requests: DataFrame, names: Sequence[str] = FEATURES) -> DataFrame:
    """The requests with the default vector; the values are literals, nothing is joined."""
    return requests.withColumns({n: F.lit(float(DEFAULT_FEATURES[n])) for n in names})


def key_bounds(stores: DataFrame, products: DataFrame) -> dict[str, Column]:
    """Smallest and largest known key of both dimensions as scalar subqueries."""
    out = {}
    for df, key in ((stores, "store_id"), (products, "product_id")):
        span = df.agg(F.min(key).alias("lo"), F.max(key).alias("hi"))
        out[f"{key}_lo"], out[f"{key}_hi"] = span.select("lo").scalar(), span.select("hi").scalar()
    return out


def validate_requests(requests: DataFrame, stores: DataFrame, products: DataFrame,
                      horizons: Sequence[int] = HORIZONS) -> DataFrame:
    """Adds ``reason``: why a request is rejected, NULL for a valid one."""
    b = key_bounds(stores, products)
    store, product = F.col("store_id"), F.col("product_id")
    reason = (F.when(store.isNull() | ~store.between(b["store_id_lo"], b["store_id_hi"]), "invalid store_id")
              .when(product.isNull() | ~product.between(b["product_id_lo"], b["product_id_hi"]), "invalid product_id")
              .when(F.col("horizon").isNull() | ~F.col("horizon").isin(*horizons), "invalid horizon"))
    return requests.withColumn("reason", reason)


def latest_features(features: DataFrame, names: Sequence[str] = FEATURES) -> DataFrame:
    """The newest feature row of every series: its date is found first, and the rows are then joined by it."""
    keys = ["store_id", "product_id"]
    newest = features.groupBy(*keys).agg(F.max("date").alias("date"))
    rows = features.select(*keys, "date", *[F.col(n).cast("double").alias(n) for n in names]).join(newest, [*keys, "date"])
    return rows.select(*keys, F.lit(True).alias("known"), *names)


def score_batch(requests: DataFrame, features: DataFrame, model: PipelineModel | Column, model_name: str,
                names: Sequence[str] = FEATURES, given: str | None = None) -> DataFrame:
    """Forecast per request from the latest features of its series, defaults where there are none.

    ``model`` is a fitted pipeline, or a model as an expression over the feature columns.
    ``given`` names a map column with features given by the caller: where it is not NULL it alone counts, and a
    feature that it lacks is 0. A request that cannot be scored gets an ``error`` and no quantity; the others are
    not affected.
    """
    known = latest_features(features, names)
    joined = requests.join(known, ["store_id", "product_id"], "left")
    default = {n: float(DEFAULT_FEATURES[n]) for n in names}
    own = F.col(given) if given else F.lit(None).cast("map<string,double>")
    # A known series keeps 0 for a missing value, as in training; an unknown one gets the default.
    filled = joined.withColumns({n: F.when(own.isNotNull(), F.coalesce(F.element_at(own, n), F.lit(0.0)))
                                 .when(F.col("known"), F.coalesce(F.col(n), F.lit(0.0))).otherwise(F.lit(default[n])) for n in names})
    scored = filled.withColumn("prediction", model) if isinstance(model, Column) else model.transform(filled)
    error = F.when(F.col("store_id").isNull() | F.col("product_id").isNull(), "missing key")
    return scored.select(
        "store_id", "product_id", F.coalesce("horizon", F.lit(HORIZONS[0])).alias("horizon_days"),
        F.when(error.isNull(), clip_round("prediction")).alias("predicted_quantity"),
        F.lit(model_name).alias("model_used"), F.coalesce("known", F.lit(False)).alias("has_history"), error.alias("error"))


def _whole(c: Column) -> Column:
    """Half-up rounding to a whole number."""
    return F.floor(c + 0.5)


def forecast_expand(scored: DataFrame, band: float = 0.15, trend: float = 0.1, weekend: float = 0.1) -> DataFrame:
    """One row per target day: base plus trend plus weekend share, with a band around it.

    ``scored`` has store_id, product_id, horizon_days, predicted_quantity and forecast_date.
    """
    days = scored.where(F.col("horizon_days") >= 1).select(
        "store_id", "product_id", "horizon_days", "forecast_date", "predicted_quantity",
        F.posexplode(F.sequence(F.lit(1), F.col("horizon_days").cast("int"))).alias("i", "step"))
    target = F.date_add("forecast_date", F.col("step"))
    boost = F.when(F.weekday(target) >= 5, F.col("predicted_quantity") * weekend).otherwise(0.0)
    value = _whole(F.col("predicted_quantity") + F.col("i") * trend + boost)
    return days.select(
        "store_id", "product_id", "horizon_days", "forecast_date", target.alias("target_date"), value.alias("value"),
        _whole(value * (1 - band)).alias("lower_bound"), _whole(value * (1 + band)).alias("upper_bound"))


def forecast_insights(curve: DataFrame, safety: float = 0.15, peak: float = 1.05, unstable: float = 20.0) -> DataFrame:
    """Inventory figures per forecast. A forecast has at most one row per horizon day."""
    keys = ["store_id", "product_id", "horizon_days"]
    days = curve.groupBy(*keys).agg(
        F.sum("value").alias("total_forecast"), F.count("value").alias("days"), F.min("value").alias("min_value"),
        F.max("value").alias("max_value"), F.sort_array(F.collect_list(F.struct("target_date", "value"))).alias("curve"))
    avg = ratio("total_forecast", "days")
    peaks = F.filter("curve", lambda d: d["value"] >= avg * peak)
    days = days.withColumns({
        "avg_demand": avg,
        "variability_pct": F.round(ratio(F.col("max_value") - F.col("min_value"), avg) * 100, 1),
        "peak_days": F.array_join(F.transform(peaks, lambda d: d["target_date"].cast("string")), ","),
        "safety_stock": _whole(F.col("max_value") * safety)})
    return days.select(*keys, F.round("avg_demand", 4).alias("avg_demand"), "total_forecast", "min_value", "max_value",
                       "variability_pct", "peak_days", "safety_stock",
                       (F.col("total_forecast") + F.col("safety_stock") * F.col("horizon_days")).alias("total_inventory"),
                       (F.col("variability_pct") > unstable).alias("high_variability"))


def forecast_rows(curve: DataFrame, model_name: str, version: str = "1.0", price: DataFrame | None = None) -> DataFrame:
    """Curve rows as forecast table rows; revenue is filled when product prices are given."""
    rows = curve.join(price.select("product_id", F.col("unit_price").cast("double").alias("_price")), "product_id", "left") \
        if price is not None else curve.withColumn("_price", F.lit(None).cast("double"))
    return rows.select(
        "forecast_date", "target_date", "store_id", "product_id", F.col("horizon_days").cast("int").alias("horizon_days"),
        F.col("value").cast("double").alias("predicted_quantity"),
        F.round(F.col("value") * F.col("_price"), 2).alias("predicted_revenue"),
        F.col("lower_bound").cast("double").alias("lower_bound"), F.col("upper_bound").cast("double").alias("upper_bound"),
        F.lit(model_name).alias("model_name"), F.lit(version).alias("model_version"),
        F.lit(None).cast("bigint").alias("actual_quantity"), F.lit(None).cast("decimal(22,4)").alias("actual_revenue"),
        F.lit(None).cast("double").alias("absolute_error"), F.lit(None).cast("double").alias("percentage_error"))


def forecast_store(existing: DataFrame, fresh: DataFrame) -> DataFrame:
    """Forecast table after storing fresh rows: a repeated forecast replaces its predicted values."""
    predicted = ["horizon_days", "predicted_quantity", "predicted_revenue", "lower_bound", "upper_bound", "model_version"]
    return upsert(existing, fresh, FORECAST_KEYS, predicted)


def forecast_backfill(forecasts: DataFrame, daily: DataFrame) -> DataFrame:
    """Fill actual values and errors of forecasts whose day has sales; other rows stay as they are."""
    actual = daily.select(F.col("date").alias("target_date"), "store_id", "product_id",
                          F.col("daily_quantity").alias("_q"), F.col("daily_revenue").alias("_r"))
    joined = forecasts.join(actual, ["target_date", "store_id", "product_id"], "left")
    qty = F.coalesce("_q", "actual_quantity")
    miss = F.abs(qty.cast("double") - F.col("predicted_quantity"))
    return joined.withColumns({
        "actual_quantity": qty, "actual_revenue": F.coalesce("_r", "actual_revenue"),
        "absolute_error": miss, "percentage_error": F.round(ratio(miss, qty) * 100, 4),
    }).select(*forecasts.columns)
