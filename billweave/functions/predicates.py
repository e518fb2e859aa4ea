"""Row filters shared by the metrics. NULL never passes any of them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as a customer number, a missing item and a price.
MOBILE_LENGTH = 10
EMPTY_ITEM = ""
NONE_ITEM = "None"
PRICE_PATTERN = r"^[0-9]+(\.[0-9]+)?\z"


def valid_customer() -> Column:
    return F.length("mobileNumber") == MOBILE_LENGTH


def known_store() -> Column:
    return F.col("storeId").isNotNull()


def named_item() -> Column:
    return F.col("itemName") != EMPTY_ITEM


def real_item() -> Column:
    return named_item() & (F.col("itemName") != NONE_ITEM)


def any_item() -> Column:
    """Not empty *or* not ``None``: true for every item name that is not NULL."""
    return F.col("itemName").isNotNull()


def numeric_price() -> Column:
    return F.col("itemPrice").rlike(PRICE_PATTERN)
