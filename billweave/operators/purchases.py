"""How often customers bought an item: bills joined with their items."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billweave.functions.calendar import AsOf, created_within, month_start
from billweave.functions.predicates import known_store, named_item, valid_customer
from billweave.operators.rollups import CUSTOMER_KEY

_PURCHASE = (*CUSTOMER_KEY, "itemName")


def _customer_bills(bills: DataFrame) -> DataFrame:
    return bills.where(known_store() & valid_customer() & F.col("billId").isNotNull())


def _bought_items(items: DataFrame) -> DataFrame:
    """Distinct items of each bill: copies of a line are gone before the join."""
    return items.where(named_item() & F.col("billId").isNotNull()).select("billId", "itemName").distinct()


def purchase_totals(bills: DataFrame, items: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Distinct bills by customer, item and latest month of the bill up to the as-of month.

    The periods asked for all end with the as-of month, so the latest month decides for
    each of them whether a bill belongs to it, even if copies of a bill differ in time.
    """
    month = F.trunc("createdAt", "month")
    of_bills = (
        _customer_bills(bills)
        .groupBy("billId", *CUSTOMER_KEY)
        .agg(F.max(F.when(month <= month_start(as_of), month)).alias("last_month"))
    )
    return (
        of_bills.join(_bought_items(items), "billId")
        .groupBy(*_PURCHASE, "last_month")
        .agg(F.count(F.lit(1)).alias("bill_count"))
    )


def customer_item_purchase_frequency(
    bills: DataFrame, items: DataFrame | None = None, as_of: AsOf = None, months: int | None = None
) -> DataFrame:
    """Distinct bills by customer and item, in the last ``months`` calendar months if given.

    Items belong to a bill by its id alone; the store is the bill's. Give bills and
    items, or ``purchase_totals`` of the same day alone. Both sides of the join are
    reduced to distinct rows first, so each joined row is one distinct bill.
    """
    if items is None:
        totals = bills
        if months is not None:
            totals = totals.where(F.col("last_month") >= month_start(as_of, months - 1))
        return totals.groupBy(*_PURCHASE).agg(F.sum("bill_count").alias("times_purchased"))
    if months is not None:
        bills = bills.where(created_within(bills, month_start(as_of, months - 1), month_start(as_of, -1)))
    return (
        _customer_bills(bills)
        .select("billId", *CUSTOMER_KEY)
        .distinct()
        .join(_bought_items(items), "billId")
        .groupBy(*_PURCHASE)
        .agg(F.count(F.lit(1)).alias("times_purchased"))
    )
