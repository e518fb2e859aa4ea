"""The two aggregates most bill metrics are read from.

``hourly_totals`` has one row per store, day and hour, ``customer_totals`` one per
customer key. Every metric that uses them takes either raw bills or a rollup made
earlier, so a batch of metrics can share two scans of the bills, while a single metric
lets Catalyst prune the aggregates it does not need. All aggregates are additive and
are combined before the shuffle, so a store or customer holding much of the data costs
one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billweave.functions.predicates import valid_customer

HOUR_KEY = ("storeId", "date", "hour")
CUSTOMER_KEY = ("storeId", "mobileNumber", "name")

_BILL_MEASURES = {
    "row_count": lambda: F.count(F.lit(1)),
    "bill_count": lambda: F.count("billId"),
    "amount_count": lambda: F.count("billAmount"),
    "amount_sum": lambda: F.sum("billAmount"),
}
_VISIT_MEASURES = {
    "first_visit": lambda: F.min("createdAt"),
    "last_visit": lambda: F.max("createdAt"),
}
_MERGES = {"first_visit": F.min, "last_visit": F.max}


def is_rollup(df: DataFrame) -> bool:
    return "row_count" in df.columns


def _merged(name: str) -> Column:
    return _MERGES.get(name, F.sum)(name).alias(name)


def _aggregate(df: DataFrame, keys: Sequence[str], measures: dict) -> DataFrame:
    if is_rollup(df):
        return df.groupBy(*keys).agg(*[_merged(name) for name in measures])
    return df.groupBy(*keys).agg(*[make().alias(name) for name, make in measures.items()])


def hourly_totals(bills: DataFrame, keys: Sequence[str] = HOUR_KEY) -> DataFrame:
    """Bill totals by ``keys``, any subset of store, day and hour."""
    if not is_rollup(bills):
        bills = bills.select(
            "storeId",
            F.to_date("createdAt").alias("date"),
            F.hour("createdAt").cast("bigint").alias("hour"),
            "billId",
            "billAmount",
        )
    return _aggregate(bills, keys, _BILL_MEASURES)


def customer_totals(bills: DataFrame, keys: Sequence[str] = CUSTOMER_KEY) -> DataFrame:
    """Bill totals and visit times by customer key, for valid customer numbers only."""
    if not is_rollup(bills):
        bills = bills.where(valid_customer())
    return _aggregate(bills, keys, {**_BILL_MEASURES, **_VISIT_MEASURES})


def average_amount() -> Column:
    """Mean amount of a rollup row; NULL if it has no amounts."""
    return F.try_divide("amount_sum", F.col("amount_count"))
