"""Calendar functions and the calendar dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.functions.exprs import col

# Holidays by (month, day) ...
FIXED_HOLIDAYS = {
    (1, 1): "New Year's Day",
    (7, 4): "Independence Day",
    (11, 11): "Veterans Day",
    (12, 25): "Christmas Day",
    (12, 31): "New Year's Eve",
}
# ... and by (month, weekday, n-th occurrence; -1 is the last one).
FLOATING_HOLIDAYS = {
    "Martin Luther King Jr. Day": (1, "MON", 3),
    "Presidents' Day": (2, "MON", 3),
    "Memorial Day": (5, "MON", -1),
    "Labor Day": (9, "MON", 1),
    "Columbus Day": (10, "MON", 2),
    "Thanksgiving": (11, "THU", 4),
}
# Days counted down to, with the day that stands for Thanksgiving.
COUNTDOWN_DAYS = [(12, 25), (11, 27), (7, 4), (1, 1)]
COUNTDOWN_CAP = 365
SEASONS = ["Winter", "Spring", "Summer", "Fall"]


def nth_weekday(month_start: Column, weekday: str, n: int) -> Column:
    """The n-th given weekday of the month that starts at ``month_start``."""
    return F.date_add(F.next_day(F.date_sub(month_start, 1), weekday), 7 * (n - 1))


def last_weekday(month_start: Column, weekday: str) -> Column:
    return F.next_day(F.date_sub(F.last_day(month_start), 7), weekday)


def holiday_name(date: str | Column) -> Column:
    """Name of the holiday on that day, NULL when there is none."""
    d = col(date)
    month, day, start = F.month(d), F.day(d), F.trunc(d, "MM")
    name = F.lit(None).cast("string")
    # The day after Thanksgiving may lie in the next month only in theory: the 4th Thursday is at most 28.
    thanksgiving = nth_weekday(start, "THU", 4)
    name = F.when((month == 11) & (d == F.date_add(thanksgiving, 1)), "Black Friday").otherwise(name)
    for label, (m, weekday, n) in FLOATING_HOLIDAYS.items():
        at = last_weekday(start, weekday) if n < 0 else nth_weekday(start, weekday, n)
        name = F.when((month == m) & (d == at), label).otherwise(name)
    for (m, dd), label in FIXED_HOLIDAYS.items():
        name = F.when((month == m) & (day == dd), label).otherwise(name)
    return name


def season(date: str | Column) -> Column:
    """Meteorological season: the quarter of the date one month later."""
    return F.element_at(F.array(*[F.lit(x) for x in SEASONS]), F.quarter(F.add_months(F.trunc(col(date), "MM"), 1)))


def days_to_holiday(date: str | Column) -> Column:
    """Days to the next countdown day strictly after ``date``, at most the cap."""
    d = col(date)
    gaps = []
    for m, dd in COUNTDOWN_DAYS:
        this_year = F.make_date(F.year(d), F.lit(m), F.lit(dd))
        next_year = F.make_date(F.year(d) + 1, F.lit(m), F.lit(dd))
        gaps.append(F.datediff(F.when(this_year > d, this_year).otherwise(next_year), d))
    return F.least(*gaps, F.lit(COUNTDOWN_CAP))


def calendar_parts(date: str | Column) -> dict[str, Column]:
    """The calendar columns as named expressions of one date."""
    d = col(date)
    name = holiday_name(d)
    return {
        "year": F.year(d),
        "month": F.month(d),
        "day": F.day(d),
        "day_of_week": F.weekday(d),
        "day_name": F.date_format(d, "EEEE"),
        "week_of_year": F.weekofyear(d),
        "quarter": F.quarter(d),
        "fiscal_quarter": F.quarter(d),
        "is_weekend": F.weekday(d) >= 5,
        "is_holiday": name.isNotNull(),
        "holiday_name": name,
        "is_month_start": F.day(d) == 1,
        "is_month_end": d == F.last_day(d),
        "days_to_holiday": days_to_holiday(d),
        "season": season(d),
    }


def calendar_dimension(bounds: DataFrame) -> DataFrame:
    """Calendar for every day between ``start_date`` and ``end_date`` of a one-row frame."""
    days = bounds.where("start_date <= end_date").select(
        F.explode(F.sequence("start_date", "end_date")).alias("date"))
    return days.select("date", *[c.alias(n) for n, c in calendar_parts("date").items()])


def calendar_between(spark: SparkSession, start: str, end: str) -> DataFrame:
    bounds = spark.range(1).select(F.lit(start).cast("date").alias("start_date"),
                                   F.lit(end).cast("date").alias("end_date"))
    return calendar_dimension(bounds)
