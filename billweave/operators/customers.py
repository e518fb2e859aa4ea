"""Customer metrics.

``bills`` is silver bills or, unless noted, a ``customer_totals`` rollup by store,
mobile number and name. The customer key differs between metrics and is part of each
metric's meaning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billweave.functions.calendar import (
    MONTH_FOLDER,
    AsOf,
    calendar_columns,
    created_within,
    day_window_conditions,
    days_before,
    month_label,
    weekday_name,
)
from billweave.functions.predicates import known_store, valid_customer
from billweave.operators.dedupe import first_per_key
from billweave.operators.rollups import CUSTOMER_KEY, average_amount, customer_totals, is_rollup

STORE_CUSTOMER = ("storeId", "mobileNumber")

# Fixed value: the ceiling of a customer's lifetime value.
CLTV_CEILING = 1e12


def _visitors(bills: DataFrame, *keys: Column, name: str) -> DataFrame:
    return bills.groupBy("storeId", *keys).agg(F.count_distinct("mobileNumber").alias(name))


def daily_customer_visits(bills: DataFrame) -> DataFrame:
    """Distinct mobile numbers of any length by store and day; needs the bills."""
    return _visitors(bills, F.to_date("createdAt").alias("date"), name="customer_visits")


def monthly_visits(bills: DataFrame) -> DataFrame:
    """Distinct mobile numbers of any length by store and month; needs the bills."""
    return _visitors(
        bills, F.trunc("createdAt", "month").alias("first_day"), name="no_of_customers"
    ).select("storeId", month_label(F.col("first_day")).alias("month"), "no_of_customers")


def avg_week(bills: DataFrame) -> DataFrame:
    """Mean daily visitors by weekday, over the days that have a bill; needs the bills."""
    return (
        daily_customer_visits(bills)
        .groupBy("storeId", weekday_name(F.col("date")).alias("weekday"))
        .agg(F.avg("customer_visits").alias("avg_visits"))
    )


def visitor_trend_date_hour(bills: DataFrame) -> DataFrame:
    """Distinct valid customers by store, day and hour; needs the bills."""
    visits = _visitors(
        bills.where(known_store() & valid_customer()),
        F.to_date("createdAt").alias("visit_date"),
        F.hour("createdAt").cast("bigint").alias("visit_hour"),
        name="visitor_count",
    )
    return visits.select(
        "storeId", "visit_date", "visit_hour", *calendar_columns(F.col("visit_date")), "visitor_count"
    )


def customer_visit_windows_dev(bills: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Distinct customers by store in each day window; needs the bills.

    A customer's windows are folded into one bit set, so each bill row is read once
    rather than once per distinct count.
    """
    windows = day_window_conditions(F.to_date("createdAt"), as_of)
    member_bits = sum(
        (F.when(inside, F.lit(1 << bit)).otherwise(0) for bit, inside in enumerate(windows.values())),
        F.lit(0),
    )
    members = (
        bills.where(known_store() & valid_customer())
        .select(*STORE_CUSTOMER, member_bits.alias("bits"))
        .groupBy(*STORE_CUSTOMER)
        .agg(F.bit_or("bits").alias("bits"))
    )
    return members.groupBy("storeId").agg(
        *[
            F.count_if(F.col("bits").bitwiseAND(1 << bit) != 0).alias(f"customers_{suffix}")
            for bit, suffix in enumerate(windows)
        ]
    )


def top_spenders(bills: DataFrame) -> DataFrame:
    return customer_totals(bills).select(
        "name", "storeId", "mobileNumber", F.col("amount_sum").alias("total_spend")
    )


def cltv(bills: DataFrame) -> DataFrame:
    lifetime = F.greatest(
        F.datediff("last_visit", "first_visit").cast("bigint"), F.lit(1).cast("bigint")
    )
    return (
        customer_totals(bills, STORE_CUSTOMER)
        .withColumn("lifetime_days", lifetime)
        .withColumn("purchase_frequency", F.col("bill_count") / F.col("lifetime_days"))
        .select(
            *STORE_CUSTOMER,
            F.col("amount_sum").alias("total_spend"),
            F.col("bill_count").alias("transaction_count"),
            average_amount().alias("avg_bill_value"),
            F.col("first_visit").alias("first_purchase"),
            F.col("last_visit").alias("last_purchase"),
            "lifetime_days",
            "purchase_frequency",
            F.least(F.col("amount_sum") * F.col("purchase_frequency"), F.lit(CLTV_CEILING)).alias("cltv_value"),
        )
    )


def churn_60day(bills: DataFrame, as_of: AsOf = None, days: int = 60) -> DataFrame:
    """Customers whose last purchase lies before midnight of the cut-off day."""
    customers = customer_totals(bills, STORE_CUSTOMER)
    cut_off = days_before(as_of, days).cast(customers.schema["last_visit"].dataType)
    churned = F.col("last_visit") < cut_off
    return (
        customers.groupBy("storeId")
        .agg(F.count(F.lit(1)).alias("total_customers"), F.count_if(churned).alias("churned_customers"))
        .withColumn("churn_rate_percent", F.lit(100.0) * F.col("churned_customers") / F.col("total_customers"))
    )


def active_cust_pct(bills: DataFrame, customer_key: Sequence[str] = CUSTOMER_KEY) -> DataFrame:
    """Customers with a bill in the store's own latest month, and with two bills or more.

    A customer is active exactly if the month of the last visit is the store's latest
    one, so customers are counted by that month and no join with the months is needed.
    """
    by_last_month = (
        customer_totals(bills.where(known_store()), customer_key)
        .groupBy("storeId", F.trunc("last_visit", "month").alias("last_month"))
        .agg(
            F.count(F.lit(1)).alias("customers"),
            F.count_if(F.col("row_count") >= 2).alias("repeaters"),
        )
    )
    total = F.col("total_customers")
    return (
        by_last_month.groupBy("storeId")
        .agg(
            F.sum("customers").alias("total_customers"),
            F.coalesce(F.max_by("customers", "last_month"), F.lit(0)).alias("active_customers"),
            F.sum("repeaters").alias("repeat_customers"),
        )
        .select(
            "storeId",
            total,
            "active_customers",
            F.round(F.lit(100.0) * F.col("active_customers") / total, 2).alias("active_customer_percentage"),
            "repeat_customers",
            F.round(F.lit(100.0) * F.col("repeat_customers") / total, 2).alias("repeat_customer_percentage"),
        )
    )


def _visits(bills: DataFrame) -> DataFrame:
    """Store, mobile, name and time of visits, of which only the latest matter."""
    known = bills.where(known_store())
    if is_rollup(known):
        return known.select(*CUSTOMER_KEY, "last_visit")
    return known.where(valid_customer()).select(*CUSTOMER_KEY, F.col("createdAt").alias("last_visit"))


def _latest_visits(visits: DataFrame, customer_key: Sequence[str]) -> DataFrame:
    if set(customer_key) == set(CUSTOMER_KEY):
        latest = visits.groupBy(*CUSTOMER_KEY).agg(F.max("last_visit").alias("last_visit"))
    else:
        order = [F.col(c).desc_nulls_last() for c in ("last_visit", "storeId", "name")]
        latest = first_per_key(visits, customer_key, order)
    return latest.select("storeId", "name", "mobileNumber", F.to_date("last_visit").alias("last_visit_date"))


def inactive_customers(
    bills: DataFrame, as_of: AsOf = None, days: int = 60, customer_key: Sequence[str] = CUSTOMER_KEY
) -> DataFrame:
    """Customers whose last visit lies more than ``days`` days back."""
    latest = _latest_visits(_visits(bills), customer_key)
    return latest.where(F.col("last_visit_date") < days_before(as_of, days))


def active_customers(
    bills: DataFrame, as_of: AsOf = None, days: int = 30, customer_key: Sequence[str] = ("mobileNumber",)
) -> DataFrame:
    """Customers seen in the last ``days`` days, with the store and name of the last visit.

    A last visit inside the period is also the last of the visits in the period, so
    older bills are dropped at the scan.
    """
    time = "last_visit" if is_rollup(bills) else "createdAt"
    recent = bills.where(created_within(bills, days_before(as_of, days), time=time))
    return _latest_visits(_visits(recent), customer_key)


def repeat_customers_name_and_number(bills: DataFrame) -> DataFrame:
    """Customers with more than one bill in a store, under their latest name."""
    newest = F.struct("last_visit", "name")
    return (
        customer_totals(bills.where(known_store()))
        .groupBy(*STORE_CUSTOMER)
        .agg(F.sum("row_count").alias("visit_count"), F.max_by("name", newest).alias("name"))
        .where("visit_count > 1")
        .select("storeId", "name", "mobileNumber", "visit_count")
    )


def storewise_data(bills: DataFrame) -> DataFrame:
    """All columns of all bills; publishing it stores them by store."""
    return bills.drop(MONTH_FOLDER)
