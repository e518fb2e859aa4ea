"""The metrics by name: what they compute, from which tables, and how they are stored."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billweave.operators import customers, products, purchases, rollups, sales, segments

BILLS, ITEMS, SEGMENTS = "bills", "items", "segments"
HOURLY, CUSTOMER, BASKETS, PURCHASES = "hourly", "customer", "baskets", "purchases"

# Shared aggregates: how they are made, from which tables, and whether for a day.
ROLLUPS: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...], bool]] = {
    HOURLY: (rollups.hourly_totals, (BILLS,), False),
    CUSTOMER: (rollups.customer_totals, (BILLS,), False),
    BASKETS: (products.baskets, (ITEMS,), False),
    PURCHASES: (purchases.purchase_totals, (BILLS, ITEMS), True),
}


@dataclass(frozen=True)
class Metric:
    """One published table.

    ``inputs`` are the tables the function takes, in order. ``rollup`` names the shared
    aggregate that may stand in for them. ``by_store`` marks rows that lie by store
    already, as the silver bills do, and need no shuffle to be stored so. ``highest_first`` or ``lowest_first`` names
    the column that sorts rows inside each file.
    """

    compute: Callable[..., DataFrame]
    inputs: tuple[str, ...] = (BILLS,)
    dated: bool = False
    rollup: str | None = None
    partition_by: str = "storeId"
    by_store: bool = False
    highest_first: str | None = None
    lowest_first: str | None = None

    @property
    def order(self) -> list[Column]:
        high = [F.col(self.highest_first).desc()] if self.highest_first else []
        return high + ([F.col(self.lowest_first).asc()] if self.lowest_first else [])

    def __call__(self, *tables: DataFrame, as_of=None) -> DataFrame:
        return self.compute(*tables, as_of=as_of) if self.dated else self.compute(*tables)


def _by_mobile(function, days: int):
    return partial(function, days=days, customer_key=("mobileNumber",))


_frequency = purchases.customer_item_purchase_frequency
_BOUGHT = {"inputs": (BILLS, ITEMS), "dated": True, "rollup": PURCHASES, "highest_first": "times_purchased"}

METRICS = {
    "daily_sales_trend": Metric(sales.daily_sales_trend, rollup=HOURLY),
    "monthly_sales_trend": Metric(sales.monthly_sales_trend, rollup=HOURLY),
    "daily_customer_visits": Metric(customers.daily_customer_visits),
    "top_spenders": Metric(customers.top_spenders, rollup=CUSTOMER, highest_first="total_spend"),
    "avg_bill_value_daily": Metric(sales.avg_bill_value_daily, rollup=HOURLY),
    "daily_bill_count": Metric(sales.daily_bill_count, rollup=HOURLY),
    "cltv": Metric(customers.cltv, rollup=CUSTOMER),
    "avg_week": Metric(customers.avg_week, highest_first="avg_visits"),
    "churn_60day": Metric(customers.churn_60day, dated=True, rollup=CUSTOMER),
    "monthly_visits": Metric(customers.monthly_visits),
    "monthly_bills": Metric(sales.monthly_bills),
    "avg_hourly_billing_trend": Metric(
        sales.avg_hourly_billing_trend, rollup=HOURLY, lowest_first="hour_of_day"
    ),
    "bill_count_windows": Metric(sales.bill_count_windows, dated=True, rollup=HOURLY),
    "sales_windows": Metric(sales.sales_windows, dated=True, rollup=HOURLY),
    "active_cust_pct": Metric(customers.active_cust_pct, rollup=CUSTOMER),
    "active_cust_pct_by_mobile": Metric(
        partial(customers.active_cust_pct, customer_key=customers.STORE_CUSTOMER), rollup=CUSTOMER
    ),
    "rfm_segments": Metric(segments.rfm_segments, dated=True, rollup=CUSTOMER),
    "cust_segment_count": Metric(segments.cust_segment_count, inputs=(SEGMENTS,)),
    "cust_segment_spend": Metric(segments.cust_segment_spend, inputs=(SEGMENTS,)),
    "average_monthly_bill_value": Metric(sales.average_monthly_bill_value, rollup=HOURLY),
    "inactive_customers_60": Metric(customers.inactive_customers, dated=True, rollup=CUSTOMER),
    "inactive_customers_30days": Metric(
        partial(customers.inactive_customers, days=30), dated=True, rollup=CUSTOMER
    ),
    "inactive_customers_90days": Metric(
        partial(customers.inactive_customers, days=90), dated=True, rollup=CUSTOMER
    ),
    "inactive_customers_60_global": Metric(
        _by_mobile(customers.inactive_customers, 60), dated=True, rollup=CUSTOMER
    ),
    "inactive_customers_30_global": Metric(
        _by_mobile(customers.inactive_customers, 30), dated=True, rollup=CUSTOMER
    ),
    "inactive_customers_90_global": Metric(
        _by_mobile(customers.inactive_customers, 90), dated=True, rollup=CUSTOMER
    ),
    "active_customers_30": Metric(customers.active_customers, dated=True, rollup=CUSTOMER),
    "repeat_customers_name_and_number": Metric(
        customers.repeat_customers_name_and_number, rollup=CUSTOMER
    ),
    "sales_trend_date_hour": Metric(sales.sales_trend_date_hour, rollup=HOURLY),
    "visitor_trend_date_hour": Metric(customers.visitor_trend_date_hour),
    "customer_visit_windows_dev": Metric(customers.customer_visit_windows_dev, dated=True),
    "top_prods_by_qt": Metric(products.top_prods_by_qt, (ITEMS,), highest_first="no_times_sold"),
    "top_prods_by_sales": Metric(products.top_prods_by_sales, (ITEMS,), highest_first="product_sale"),
    "product_basket": Metric(products.product_basket, (ITEMS,), rollup=BASKETS, highest_first="combination_count"),
    "product_pairs": Metric(products.product_pairs, (ITEMS,), rollup=BASKETS, highest_first="pair_count"),
    "product_quantity_this_month": Metric(products.product_quantity_this_month, (ITEMS,), highest_first="times_sold"),
    "product_quantity_this_quarter": Metric(products.product_quantity_this_quarter, (ITEMS,), highest_first="times_sold"),
    "product_sales_this_month": Metric(
        products.product_sales_this_month, (ITEMS,), dated=True, highest_first="product_sale"
    ),
    "product_sales_last_3_month": Metric(products.product_sales_last_3_month, (ITEMS,), highest_first="product_sale"),
    "customer_item_purchase_frequency": Metric(_frequency, **_BOUGHT),
    "customer_item_purchase_frequency_current_month": Metric(partial(_frequency, months=1), **_BOUGHT),
    "customer_item_purchase_frequency_last3_month": Metric(partial(_frequency, months=3), **_BOUGHT),
    "customer_item_purchase_frequency_last6_month": Metric(partial(_frequency, months=6), **_BOUGHT),
    "storewise_data": Metric(customers.storewise_data, by_store=True),
}
