"""Column expressions shared by the operators; all stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Report labels.
TEMPERATURE_BANDS = [
    (32, "Freezing (<32°F)"), (50, "Cold (32-50°F)"), (70, "Mild (50-70°F)"), (85, "Warm (70-85°F)"),
]
HOTTEST = "Hot (>85°F)"
DRY = "No Rain"
RAIN_LEVELS = [("0.1", 'Light Rain (<0.1")'), ("0.5", 'Moderate Rain (0.1-0.5")')]
HEAVIEST = 'Heavy Rain (>0.5")'
ABC_CLASSES = [(80, "A - High Value"), (95, "B - Medium Value")]
ABC_REST = "C - Low Value"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(num: str | Column, den: str | Column) -> Column:
    """``num / den`` as double, NULL when the denominator is zero or NULL."""
    return F.try_divide(col(num).cast("double"), col(den).cast("double"))


def ratio_pct(num: str | Column, den: str | Column, places: int = 2) -> Column:
    return F.round(ratio(num, den) * 100, places)


def mean(c: str | Column) -> Column:
    """Average as exact sum over count, so it does not depend on the order of addition."""
    return F.try_divide(F.sum(c).cast("double"), F.count(c))


def growth_pct(now: str | Column, before: str | Column, places: int = 2) -> Column:
    """Growth in percent, NULL unless the earlier value is positive."""
    return F.when(col(before) > 0, F.round(ratio(col(now) - col(before), before) * 100, places))


def change_pct(now: str | Column, before: str | Column, places: int = 2) -> Column:
    """Growth in percent, NULL only when the earlier value is zero or NULL."""
    return F.round(ratio(col(now) - col(before), before) * 100, places)


def _banded(value: Column, bands, rest: str, below) -> Column:
    expr = None
    for limit, label in bands:
        test = below(value, limit)
        expr = F.when(test, label) if expr is None else expr.when(test, label)
    return expr.otherwise(rest)


def avg_temperature(high: str | Column, low: str | Column, whole: bool = True) -> Column:
    """Mean of the two temperatures; ``whole`` truncates as integer columns do in the reports."""
    total = col(high) + col(low)
    return F.call_function("div", total, F.lit(2)) if whole else total / 2


def temperature_band(value: str | Column) -> Column:
    """Five bands; NULL falls into the hottest one."""
    return _banded(col(value), TEMPERATURE_BANDS, HOTTEST, lambda v, x: v < x)


def precipitation_level(value: str | Column) -> Column:
    """Four levels; NULL falls into the heaviest one."""
    v = col(value)
    expr = F.when(v == 0, DRY)
    for limit, label in RAIN_LEVELS:
        expr = expr.when(v < F.lit(limit).cast("decimal(5,2)"), label)
    return expr.otherwise(HEAVIEST)


def abc_class(cumulative_pct: str | Column) -> Column:
    return _banded(col(cumulative_pct), ABC_CLASSES, ABC_REST, lambda v, x: v <= x)


def value_segment(value: str | Column, high: Column, mid: Column) -> Column:
    v = col(value)
    return F.when(v >= high, "High Value").when(v >= mid, "Medium Value").otherwise("Low Value")


def frequency_segment(orders: str | Column) -> Column:
    n = col(orders)
    return F.when(n >= 10, "Loyal").when(n >= 3, "Regular").otherwise("New")


def month_of(date: str | Column) -> Column:
    return F.trunc(col(date), "MM")


def week_of(date: str | Column) -> Column:
    return F.to_date(F.date_trunc("week", col(date)))


def months_between_starts(later: str | Column, earlier: str | Column) -> Column:
    """Whole months between two month starts."""
    return F.months_between(col(later), col(earlier)).cast("int")


def clip_round(value: str | Column, places: int = 2) -> Column:
    """Forecasts are never negative."""
    return F.round(F.greatest(F.lit(0.0), col(value)), places)


def equal_width_bin(value: str | Column, low: Column, high: Column, bins: int) -> Column:
    """1-based histogram bin; the last bin also holds the maximum."""
    v = col(value).cast("double")
    bin_no = F.width_bucket(v, low, high, F.lit(bins))
    return F.when(low == high, F.lit(1)).otherwise(F.least(bin_no, F.lit(bins))).cast("long")
