"""One row per key, with a stated survivor."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

ITEM_KEY = ("billId", "createdAt", "itemName")

#: Rows are counted by so many hashes of their keys. A hash is crowded with so many times its
#: share of the rows, and so many more.
_HASHES, _SHARES, _MORE = 4096, 4, 100_000


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in ``order``; NULL keys are equal.

    Spark keeps one row per key and task before the shuffle (WindowGroupLimit), so a
    key with very many copies stays cheap.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def _key_hash(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(_HASHES))


def _crowded(df: DataFrame, keys: Sequence[str]) -> list[int]:
    """Hashes of keys with so many rows that a key may hold more than one task should get.

    At most one number per hash reaches the driver.
    """
    counts = {r["hash"]: r["count"] for r in df.groupBy(_key_hash(keys).alias("hash")).count().collect()}
    most = _SHARES * sum(counts.values()) / _HASHES + _MORE
    return sorted(h for h, n in counts.items() if n > most)


def first_per_key_in_ranges(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """``first_per_key``, its rows in ranges of the keys: a task has neighbours by ``keys[0]``.

    So rows are moved once where a layout follows the first key. Ranges are cut before any
    copy is gone; keys of crowded hashes are therefore cut to one row per task first, and
    what is left of them is moved to ranges of its own. Reads ``df`` once more to count.
    """
    crowded = _crowded(df, keys)
    if not crowded:
        return first_per_key(df.repartitionByRange(*keys), keys, order)
    among = _key_hash(keys).isin(crowded)
    spread = first_per_key(df.where(~among).repartitionByRange(*keys), keys, order)
    return spread.union(first_per_key(df.where(among), keys, order).repartitionByRange(*keys))


def distinct_items(items: DataFrame, by_time: bool = False) -> DataFrame:
    """One line per bill, time and item: the newest load, then a fixed tie-break.

    Every other column takes part in the tie-break, so reruns agree. With ``by_time`` the
    lines lie in ranges of ``createdAt``.
    """
    leading = ["load_time", "itemPrice", "storeId"]
    rest = [c for c in sorted(items.columns) if c not in (*ITEM_KEY, *leading)]
    order = [F.col(c).desc_nulls_last() for c in leading + rest if c in items.columns]
    if by_time:
        return first_per_key_in_ranges(items, ("createdAt", *[k for k in ITEM_KEY if k != "createdAt"]), order)
    return first_per_key(items, ITEM_KEY, order)
