"""Dates relative to an as-of day, and the calendar columns the metrics report."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AsOf = Column | dt.date | str | None

# The day windows, as (suffix, first day, last day) counted in days
# before the as-of day. No last day means the window also takes later days; no
# first day means every row.
DAY_WINDOWS = (
    ("today", 0, 0),
    ("yesterday", 1, 1),
    ("last_2_days", 1, None),
    ("prev_2_days", 3, 2),
    ("last_7_days", 6, None),
    ("prev_7_days", 13, 7),
    ("last_1_month", 30, None),
    ("prev_1_month", 60, 31),
    ("last_90_days", 90, None),
    ("prev_90_days", 180, 91),
    ("lifetime", None, None),
)

# Weekday names, Sunday first as Spark's dayofweek counts.
WEEKDAYS = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")


# Optional partition column of the silver tables: the month of ``createdAt``. Spark skips
# folders by it, while it does not skip parquet row groups by a naive timestamp. Rows
# without a time have a month that sorts before all others.
MONTH_FOLDER = "createdMonth"
NO_MONTH = "0000-00"


def as_of_day(as_of: AsOf = None) -> Column:
    """The as-of day as a foldable date column; today when none is given."""
    if as_of is None:
        return F.current_date()
    return (as_of if isinstance(as_of, Column) else F.lit(as_of)).cast("date")


def days_before(as_of: AsOf, days: int) -> Column:
    return F.date_sub(as_of_day(as_of), days)


def month_start(as_of: AsOf, months_back: int = 0) -> Column:
    """First day of the as-of month, or of a month before it (after it if negative)."""
    return F.add_months(F.trunc(as_of_day(as_of), "month"), -months_back)


def created_within(
    df: DataFrame, first: Column, following: Column | None = None, time: str = "createdAt"
) -> Column:
    """Rows from midnight of ``first`` on and, if given, before midnight of ``following``.

    The bounds take the type of the column, which is then compared uncast. Where the
    table has month folders, those outside the bounds are not read.
    """
    kind = df.schema[time].dataType
    within = F.col(time) >= first.cast(kind)
    if following is not None:
        within &= F.col(time) < following.cast(kind)
    if MONTH_FOLDER in df.columns:
        within &= F.col(MONTH_FOLDER) >= month_label(first)
        if following is not None:
            within &= F.col(MONTH_FOLDER) <= month_label(following)
    return within


def month_folder(time: str = "createdAt") -> Column:
    return F.coalesce(month_label(F.to_date(time)), F.lit(NO_MONTH))


def day_window_conditions(day: Column, as_of: AsOf) -> dict[str, Column]:
    conditions = {}
    for suffix, first, last in DAY_WINDOWS:
        if first is None:
            conditions[suffix] = F.lit(True)
        elif last is None:
            conditions[suffix] = day >= days_before(as_of, first)
        else:
            conditions[suffix] = day.between(days_before(as_of, first), days_before(as_of, last))
    return conditions


def month_label(day: Column) -> Column:
    """``yyyy-MM`` of a date, without going through the session time zone."""
    return F.substring(day.cast("string"), 1, 7)


def weekday_name(day: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, WEEKDAYS)), F.dayofweek(day))


def calendar_columns(day: Column) -> list[Column]:
    return [
        F.year(day).cast("bigint").alias("year"),
        F.quarter(day).cast("bigint").alias("quarter"),
        F.month(day).cast("bigint").alias("month"),
        month_label(day).alias("year_month"),
        F.weekofyear(day).cast("bigint").alias("week"),
    ]
