"""Sales and bill-count metrics by store and time.

``bills`` is silver bills or an ``hourly_totals`` rollup, unless noted otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billweave.functions.calendar import AsOf, calendar_columns, day_window_conditions, month_label
from billweave.functions.predicates import known_store
from billweave.operators.rollups import HOUR_KEY, average_amount, hourly_totals

_DAY_KEY = ("storeId", "date")


def _monthly(bills: DataFrame, *aggregates: Column) -> DataFrame:
    daily = hourly_totals(bills, _DAY_KEY)
    return (
        daily.groupBy("storeId", F.trunc("date", "month").alias("first_day"))
        .agg(F.sum("amount_sum").alias("amount_sum"), F.sum("amount_count").alias("amount_count"))
        .select("storeId", month_label(F.col("first_day")).alias("month"), *aggregates)
    )


def daily_sales_trend(bills: DataFrame) -> DataFrame:
    return hourly_totals(bills, _DAY_KEY).select(
        "storeId", "date", F.col("amount_sum").alias("total_sales")
    )


def monthly_sales_trend(bills: DataFrame) -> DataFrame:
    return _monthly(bills, F.col("amount_sum").alias("total_sales"))


def average_monthly_bill_value(bills: DataFrame) -> DataFrame:
    return _monthly(bills, average_amount().alias("avg_sales"))


def avg_bill_value_daily(bills: DataFrame) -> DataFrame:
    return hourly_totals(bills, _DAY_KEY).select(
        "storeId", "date", average_amount().alias("avg_bill_value")
    )


def daily_bill_count(bills: DataFrame) -> DataFrame:
    return hourly_totals(bills, _DAY_KEY).select("storeId", "date", "bill_count")


def monthly_bills(bills: DataFrame) -> DataFrame:
    """Distinct bills by store and month; needs the bills themselves, not a rollup."""
    return (
        bills.groupBy("storeId", F.trunc("createdAt", "month").alias("first_day"))
        .agg(F.count_distinct("billId").alias("no_of_bills"))
        .select("storeId", month_label(F.col("first_day")).alias("month"), "no_of_bills")
    )


def avg_hourly_billing_trend(bills: DataFrame) -> DataFrame:
    """Mean bills per hour of day, over the days that have a bill in that hour."""
    return (
        hourly_totals(bills, HOUR_KEY)
        .groupBy("storeId", F.col("hour").alias("hour_of_day"))
        .agg(F.avg("row_count").alias("avg_bill_count"))
    )


def bill_count_windows(bills: DataFrame, as_of: AsOf = None) -> DataFrame:
    windows = day_window_conditions(F.col("date"), as_of)
    return (
        hourly_totals(bills.where(known_store()), _DAY_KEY)
        .groupBy("storeId")
        .agg(
            *[
                F.sum(F.when(inside, F.col("row_count")).otherwise(0)).alias(f"bills_{suffix}")
                for suffix, inside in windows.items()
            ]
        )
    )


def sales_windows(bills: DataFrame, as_of: AsOf = None) -> DataFrame:
    windows = day_window_conditions(F.col("date"), as_of)
    return (
        hourly_totals(bills.where(known_store()), _DAY_KEY)
        .groupBy("storeId")
        .agg(
            *[
                F.coalesce(F.sum(F.when(inside, F.col("amount_sum"))), F.lit(0.0)).alias(f"sales_{suffix}")
                for suffix, inside in windows.items()
            ]
        )
    )


def sales_trend_date_hour(bills: DataFrame) -> DataFrame:
    return hourly_totals(bills.where(known_store()), HOUR_KEY).select(
        "storeId",
        F.col("date").alias("sale_date"),
        F.col("hour").alias("sale_hour"),
        *calendar_columns(F.col("date")),
        F.col("amount_sum").alias("total_sales"),
        F.col("row_count").alias("bill_count"),
    )
