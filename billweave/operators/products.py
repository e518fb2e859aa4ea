"""Product metrics over silver items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billweave.functions.calendar import MONTH_FOLDER, AsOf, created_within, month_start
from billweave.functions.predicates import any_item, known_store, named_item, numeric_price, real_item
from billweave.operators.dedupe import distinct_items

_SALE = ("billId", "createdAt", "itemName", "storeId")
_BASKET = ("storeId", "billId", "createdAt")

# Items of a basket, or of a block of a larger basket, that are paired in one task.
PAIR_BLOCK = 256


def _since_recent_month(items: DataFrame, months: int) -> Column:
    """Lines of the latest ``months`` calendar months that occur in *all* the items.

    Months are ordered, so being one of the latest is a lower bound on the time, found
    by a one-row subquery. Month folders give it without reading any item.
    """
    folders = MONTH_FOLDER in items.columns
    month = F.col(MONTH_FOLDER) if folders else F.trunc("createdAt", "month")
    if months == 1:
        oldest = items.agg(F.max(month).alias("month"))
    else:
        found = items.select(month.alias("month")).distinct()
        recent = found.orderBy(F.col("month").desc_nulls_last()).limit(months)
        oldest = recent.agg(F.min("month").alias("month"))
    if folders:
        return (F.col(MONTH_FOLDER) >= oldest.scalar()) & F.col("createdAt").isNotNull()
    return created_within(items, oldest.scalar())


def _times_sold(items: DataFrame) -> DataFrame:
    sales = items.where(real_item()).select(*_SALE).distinct()
    return sales.groupBy("storeId", "itemName").agg(F.count(F.lit(1)).alias("times_sold"))


def _product_sale(items: DataFrame) -> DataFrame:
    """Sum of prices; equal lines of one bill at one price count once."""
    priced = items.where(named_item() & numeric_price()).select(*_SALE, "itemPrice").distinct()
    price = F.col("itemPrice").cast("double")
    return priced.groupBy("storeId", "itemName").agg(F.sum(price).alias("product_sale"))


def top_prods_by_qt(items: DataFrame) -> DataFrame:
    """Lines sold, once per bill, time and item; also counts empty and ``None`` names."""
    return (
        distinct_items(items.where(any_item()))
        .groupBy("storeId", "itemName")
        .agg(F.count("itemName").alias("no_times_sold"))
    )


def top_prods_by_sales(items: DataFrame) -> DataFrame:
    return _product_sale(items)


def product_quantity_this_month(items: DataFrame) -> DataFrame:
    """Times sold in the latest month found in the items of all stores."""
    return _times_sold(items.where(_since_recent_month(items, 1)))


def product_quantity_this_quarter(items: DataFrame) -> DataFrame:
    """Times sold in the latest three months found in the items of all stores."""
    return _times_sold(items.where(_since_recent_month(items, 3)))


def product_sales_this_month(items: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Sales in the calendar month of the as-of day."""
    return _product_sale(items.where(created_within(items, month_start(as_of), month_start(as_of, -1))))


def product_sales_last_3_month(items: DataFrame) -> DataFrame:
    """Sales in the latest three months found in the items of all stores."""
    return _product_sale(items.where(_since_recent_month(items, 3)))


def baskets(items: DataFrame) -> DataFrame:
    """The sorted distinct items of each bill that has two or more.

    Repeats are removed before and after the shuffle, so a basket holds at most the
    catalogue, however many lines its bill has. Baskets made earlier pass unchanged.
    """
    if "item_combination" in items.columns:
        return items
    return (
        items.where(named_item() & known_store())
        .groupBy(*_BASKET)
        .agg(F.array_sort(F.collect_set("itemName")).alias("item_combination"))
        .where(F.size("item_combination") >= 2)
    )


def product_basket(items: DataFrame) -> DataFrame:
    """Bills by their exact combination of items; takes items or ``baskets``."""
    combination = baskets(items).select(
        "storeId", "item_combination", F.size("item_combination").cast("bigint").alias("item_count")
    )
    return combination.groupBy("storeId", "item_combination", "item_count").agg(
        F.count(F.lit(1)).alias("combination_count")
    )


def product_pairs(items: DataFrame, block: int = PAIR_BLOCK) -> DataFrame:
    """Bills in which two products occur together, each pair once, in name order.

    Takes items or ``baskets``. A basket is cut into blocks. The pairs inside a block are
    made where it is; for two blocks of a basket only their numbers are sent around, and
    each couple fetches its two blocks by a join, so no row holds more than two blocks and
    the couples of a large basket are dealt out over the cluster.
    """
    starts = F.sequence(F.lit(1), F.size("item_combination"), F.lit(block))
    parts = F.transform(starts, lambda start: F.slice("item_combination", start, F.lit(block)))
    blocks = (
        baskets(items)
        .where(F.col("billId").isNotNull() & F.col("createdAt").isNotNull())
        .select(*_BASKET, parts.alias("parts"))
        .select(*_BASKET, F.size("parts").alias("last"), F.posexplode("parts").alias("number", "part"))
    )
    pairs = _pairs_inside(blocks).unionByName(_pairs_between(blocks))
    return pairs.groupBy("storeId", "product_a", "product_b").agg(F.count(F.lit(1)).alias("pair_count"))


def _pairs_inside(blocks: DataFrame) -> DataFrame:
    first = blocks.select("storeId", "part", F.posexplode("part").alias("place", "product_a"))
    later = F.slice("part", F.col("place") + 2, F.size("part"))
    return first.select("storeId", "product_a", F.explode(later).alias("product_b"))


def _pairs_between(blocks: DataFrame) -> DataFrame:
    """Pairs of an item and one in a later block of its basket; blocks are in order."""
    part = lambda name: blocks.where("last > 1").select(*_BASKET, F.col("number").alias(name), F.col("part").alias(f"{name}_part"))
    couples = blocks.where("number + 1 < last").select(
        *_BASKET, F.col("number").alias("left"), F.explode(F.expr("sequence(number + 1, last - 1)")).alias("right")
    )
    # A stated number of partitions: couples are small, and would else be put together
    # again, but each grows to the square of the block.
    partitions = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fetched = (
        couples.join(part("left"), [*_BASKET, "left"])
        .join(part("right"), [*_BASKET, "right"])
        .repartition(partitions, *_BASKET, "left", "right")
    )
    return fetched.select("storeId", "right_part", F.explode("left_part").alias("product_a")).select(
        "storeId", "product_a", F.explode("right_part").alias("product_b")
    )
