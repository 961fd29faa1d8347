"""Forecast features per store and product series."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from shelfline.functions.exprs import ratio
from shelfline.operators.ordered import block_of, range_cuts
from shelfline.operators.promotions import with_active_discount
from shelfline.session import materialize

LAGS = (7, 14, 30)
WINDOWS = (7, 14, 30)
EXTREMES_WINDOW = 7
ENTITY_ROWS = 30
STORE_MEAN, PRODUCT_MEAN = "store_avg_daily_sales_30d", "product_avg_daily_sales_30d"
KEYS = ["store_id", "product_id"]
TARGET = "daily_quantity"

# The model features in their stored order.
FEATURES = [
    "sales_lag_7", "sales_lag_14", "sales_lag_30", "qty_lag_7", "qty_lag_14", "qty_lag_30",
    "rolling_mean_7", "rolling_mean_14", "rolling_mean_30", "rolling_std_7", "rolling_std_14", "rolling_std_30",
    "rolling_min_7", "rolling_max_7", "day_of_week", "week_of_year", "month", "quarter", "is_weekend", "is_holiday",
    "days_to_holiday", "store_size_sqft", "product_price", "is_perishable", "temp_high_f", "temp_low_f",
    "precipitation_inches", "has_promotion", "promotion_discount", "store_avg_daily_sales_30d",
    "product_avg_daily_sales_30d",
]
# Dimension columns and the feature each becomes.
CALENDAR_FEATURES = {c: c for c in (
    "day_of_week", "week_of_year", "month", "quarter", "is_weekend", "is_holiday", "days_to_holiday", "season")}
STORE_FEATURES = {"region": "store_region", "store_format": "store_format", "size_sqft": "store_size_sqft"}
PRODUCT_FEATURES = {"category": "product_category", "subcategory": "product_subcategory",
                    "unit_price": "product_price", "is_perishable": "is_perishable"}
WEATHER_FEATURES = {"temp_high_f": "temp_high_f", "temp_low_f": "temp_low_f",
                    "precipitation_inches": "precipitation_inches", "conditions": "weather_conditions"}


def enrich(df: DataFrame, dim: DataFrame, keys: Sequence[str], names: Mapping[str, str]) -> DataFrame:
    """Left join of the listed dimension columns under their feature names; absent ones are skipped."""
    picked = [F.col(c).alias(out) for c, out in names.items() if c in dim.columns]
    return df.join(dim.select(*keys, *picked), list(keys), "left")


def series(by: Sequence[str] = KEYS) -> W:
    """Order of one series. It has one row per day, so its size is bounded by the calendar."""
    return W.partitionBy(*by).orderBy("date")


def lag_columns(lags: Sequence[int] = LAGS, by: Sequence[str] = KEYS) -> dict[str, Column]:
    w = series(by)
    out = {f"sales_lag_{n}": F.lag("daily_revenue", n).over(w) for n in lags}
    out.update({f"qty_lag_{n}": F.lag("daily_quantity", n).over(w) for n in lags})
    return out


def rolling_columns(windows: Sequence[int] = WINDOWS, by: Sequence[str] = KEYS) -> dict[str, Column]:
    """Statistics of the previous n rows, the current one excluded."""
    out = {}
    for n in windows:
        w = series(by).rowsBetween(-n, -1)
        out[f"rolling_mean_{n}"] = ratio(F.sum("daily_revenue").over(w), F.count("daily_revenue").over(w))
        out[f"rolling_std_{n}"] = F.stddev_samp(F.col("daily_revenue").cast("double")).over(w)
        if n == EXTREMES_WINDOW:
            out[f"rolling_min_{n}"] = F.min("daily_revenue").over(w)
            out[f"rolling_max_{n}"] = F.max("daily_revenue").over(w)
    return out


def feat_lags(df: DataFrame, lags: Sequence[int] = LAGS) -> DataFrame:
    """Revenue and quantity ``n`` rows earlier in the same series (gaps in dates are not filled)."""
    return df.withColumns(lag_columns(lags))


def feat_rolling(df: DataFrame, windows: Sequence[int] = WINDOWS) -> DataFrame:
    return df.withColumns(rolling_columns(windows))


def feat_calendar(df: DataFrame, calendar: DataFrame) -> DataFrame:
    return enrich(df, calendar, ["date"], CALENDAR_FEATURES)


def feat_store(df: DataFrame, stores: DataFrame) -> DataFrame:
    return enrich(df, stores, ["store_id"], STORE_FEATURES)


def feat_product(df: DataFrame, products: DataFrame) -> DataFrame:
    return enrich(df, products, ["product_id"], PRODUCT_FEATURES)


def feat_weather(df: DataFrame, weather: DataFrame) -> DataFrame:
    return enrich(df, weather, ["date", "store_id"], WEATHER_FEATURES)


def fill_promotion(df: DataFrame) -> DataFrame:
    """No promotion where none is known; the columns are added when they are missing."""
    has = F.coalesce(F.col("has_promotion"), F.lit(False)) if "has_promotion" in df.columns else F.lit(False)
    pct = F.coalesce(F.col("promotion_discount"), F.lit(0)) if "promotion_discount" in df.columns else F.lit(0)
    return df.withColumns({"has_promotion": has, "promotion_discount": pct})


def feat_promotion(df: DataFrame, promotions: DataFrame | None) -> DataFrame:
    """Promotion flag and largest discount of the day."""
    if promotions is not None:
        df = with_active_discount(df, promotions).withColumn("has_promotion", F.col("promotion_discount").isNotNull())
    return fill_promotion(df)


def previous_rows_mean(df: DataFrame, value: str, group: str, inner: str, rows: int, out: str,
                       cuts: int | None = None, keep_block: bool = False) -> DataFrame:
    """Mean of ``value`` over the previous ``rows`` rows of ``group`` in (``inner``, date) order.

    A group can hold a large part of all rows. It is therefore cut into blocks of ``inner`` values; each block also receives the last ``rows`` rows before it, taken
    from the tails of the preceding blocks, and is then windowed on its own. ``keep_block`` leaves the
    block number in the result, for later windows that can use the same partitioning.
    """
    keyed = df.withColumn("_cuts", range_cuts(df, inner, cuts)).withColumn(
        "_block", block_of(F.col(inner), F.col("_cuts"))).drop("_cuts")
    part = [group, "_block"]
    frame = W.partitionBy(*part).orderBy(inner, "date").rowsBetween(-rows, -1)
    mean = ratio(F.sum(value).over(frame), F.count(value).over(frame))
    last = W.partitionBy(*part).orderBy(F.col(inner).desc(), F.col("date").desc())
    tails = (keyed.select(*part, inner, "date", value, F.row_number().over(last).alias("_rn"))
             .where(F.col("_rn") <= rows)
             .groupBy(*part).agg(F.sort_array(F.collect_list(F.struct(inner, "date", value))).alias("_tail")))
    # Every listed block has a row, so the previous `rows` blocks hold enough of them.
    earlier = W.partitionBy(group).orderBy("_block").rowsBetween(-rows, -1)
    carried = tails.select(*part, F.flatten(F.collect_list("_tail").over(earlier)).alias("_all"))
    start = F.greatest(F.size("_all") - rows + 1, F.lit(1))
    halo = (carried.where(F.size("_all") > 0)
            .select(*part, F.explode(F.slice("_all", start, rows)).alias("_r"))
            .select(*part, f"_r.{inner}", "_r.date", f"_r.{value}", F.lit(True).alias("_halo")))
    both = keyed.withColumn("_halo", F.lit(False)).unionByName(halo, allowMissingColumns=True)
    done = both.withColumn(out, mean).where(~F.col("_halo")).drop("_halo")
    return done if keep_block else done.drop("_block")


def entity_day_mean(df: DataFrame, entity: str, days: int, out: str) -> DataFrame:
    """Mean daily total of an entity over the previous ``days`` calendar days."""
    daily = df.groupBy(entity, "date").agg(F.sum("daily_revenue").alias("_total"))
    day_no = F.datediff("date", F.lit("1970-01-01"))
    w = W.partitionBy(entity).orderBy("_day").rangeBetween(-days, -1)
    daily = daily.withColumn("_day", day_no).withColumn(out, ratio(F.sum("_total").over(w), F.count("_total").over(w)))
    return df.join(daily.select(entity, "date", out), [entity, "date"], "left")


def feat_entity_avg(df: DataFrame, rows: int = ENTITY_ROWS, by_day: bool = False,
                    cuts: int | None = None) -> DataFrame:
    """Store and product means over the previous ``rows`` rows (or days) of the entity."""
    if by_day:
        return entity_day_mean(entity_day_mean(df, "store_id", rows, STORE_MEAN), "product_id", rows, PRODUCT_MEAN)
    df = materialize(df, "series")
    df = previous_rows_mean(df, "daily_revenue", "store_id", "product_id", rows, STORE_MEAN, cuts)
    return previous_rows_mean(df, "daily_revenue", "product_id", "store_id", rows, PRODUCT_MEAN, cuts)


def feat_table(daily: DataFrame, calendar: DataFrame, stores: DataFrame, products: DataFrame,
               weather: DataFrame | None = None, promotions: DataFrame | None = None,
               lags: Sequence[int] = LAGS, windows: Sequence[int] = WINDOWS) -> DataFrame:
    """All features of every series row that has a first lag.

    Promotions and weather join first, while rows are narrow and still partitioned by the daily
    aggregation; their keys are unique, so no row is added. The result is stored once. A store's rows
    are then ordered by product and date for the store mean; a series is a run of that order, so its
    lags and rolling windows need no further shuffle or sort. The product mean and the dimensions
    follow.
    """
    df = daily.select("date", *KEYS, "daily_quantity", "daily_revenue")
    if promotions is not None:
        df = feat_promotion(df, promotions)
    if weather is not None:
        df = feat_weather(df, weather)
    df = materialize(df, "series")
    df = previous_rows_mean(df, "daily_revenue", "store_id", "product_id", ENTITY_ROWS, STORE_MEAN, keep_block=True)
    by = ["store_id", "_block", "product_id"]
    df = df.withColumns({**lag_columns(lags, by), **rolling_columns(windows, by)}).drop("_block")
    df = previous_rows_mean(df, "daily_revenue", "product_id", "store_id", ENTITY_ROWS, PRODUCT_MEAN)
    df = df.dropna(subset=[f"sales_lag_{lags[0]}"])
    return feat_product(feat_store(feat_calendar(df, calendar), stores), products)
