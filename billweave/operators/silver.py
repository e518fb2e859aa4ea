"""Silver bills and items."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billweave.operators.dedupe import distinct_items, first_per_key
from billweave.operators.incremental import incremental_load, moment, stamped
from billweave.schemas import SILVER

# Bronze inputs with an amount, best first, and their lineage columns in silver.
EXTRACTIONS = {
    "invoiceExtractedData": ("in_id", "load_in"),
    "receiptExtractedData": ("rec_id", "load_rec"),
    "billtransactions": ("bt_id", "load_bt"),
}
BILL_INPUTS = ("billRequest", *EXTRACTIONS)


def _rest_order(df: DataFrame, *used: str) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in sorted(df.columns) if c not in used]


def _first_request(requests: DataFrame) -> DataFrame:
    """One request per bill: the earliest that names a store.

    A later copy of a request never changes a bill, so a bill stays in its store.
    """
    needed = ["billId", "name", "mobileNumber", "age", "email", "gender", "storeId", "createdAt", "trans_time"]
    requests = requests.select(*needed, "load_time", "_id")
    order = [
        F.col("storeId").isNull().asc(),
        F.col("trans_time").asc_nulls_last(),
        F.col("load_time").asc_nulls_last(),
        F.col("_id").asc_nulls_last(),
        *_rest_order(requests, "billId", "trans_time", "load_time", "_id"),
    ]
    return first_per_key(requests, ["billId"], order).select(*needed).withColumnRenamed("trans_time", "load_br")


def _best_extraction(extraction: DataFrame, id_name: str, load_name: str) -> DataFrame:
    """One row per bill: one with an amount if there is any, then the newest load."""
    rows = extraction.where(F.col("billId").isNotNull()).select("billId", "billAmount", "trans_time", "load_time")
    order = [
        F.col("billAmount").isNull().asc(),
        F.col("trans_time").desc_nulls_last(),
        F.col("load_time").desc_nulls_last(),
        F.col("billAmount").desc_nulls_last(),
    ]
    return first_per_key(rows, ["billId"], order).select(
        "billId",
        F.col("billId").alias(id_name),
        F.col("billAmount").alias(f"{id_name}_amount"),
        F.col("trans_time").alias(load_name),
    )


def current_stores(stores: DataFrame) -> DataFrame:
    """Stores are loaded again and again; the newest description counts."""
    order = [F.col("trans_time").desc_nulls_last(), F.col("load_time").desc_nulls_last(), F.col("storeName").asc_nulls_last()]
    rows = stores.where(F.col("storeId").isNotNull()).select("storeId", "storeName", "trans_time", "load_time")
    return first_per_key(rows, ["storeId"], order).select("storeId", "storeName")


def _assembled(bronze: Mapping[str, DataFrame], stores: DataFrame) -> DataFrame:
    """Each input is cut to one row per bill before the joins.

    So the joins cannot fan out, copies are gone before the shuffle, and all joins use
    the partitioning by bill that the cut has made.
    """
    joined = _first_request(bronze["billRequest"])
    for name, (id_name, load_name) in EXTRACTIONS.items():
        joined = joined.join(_best_extraction(bronze[name], id_name, load_name), "billId", "left")
    amounts = [F.col(f"{id_name}_amount") for id_name, _ in EXTRACTIONS.values()]
    return joined.withColumn("billAmount", F.coalesce(*amounts)).join(current_stores(stores), "storeId", "left")


def silver_bills(
    bronze: Mapping[str, DataFrame],
    run_time: dt.datetime,
    watermarks: Mapping[str, dt.datetime | None] | None = None,
) -> DataFrame:
    """Bills with their amount, lineage and store; one row per bill.

    ``bronze`` maps collection names to bronze tables. Of an input with a watermark only the
    rows after it take part, on both sides of the joins, so an extraction finds its bill
    only in the load that brings both. An input without one takes part with all its rows.
    """
    watermarks = watermarks or {}
    inputs = {n: incremental_load(bronze[n], "trans_time", watermarks.get(n)) for n in BILL_INPUTS}
    bills = _assembled(inputs, bronze["storeDetails"])
    return stamped(bills, "load_time", run_time).select(*SILVER["all_bills"].names)


def affected_bills(
    bronze: Mapping[str, DataFrame], watermarks: Mapping[str, dt.datetime | None]
) -> DataFrame:
    """Ids of the bills that a new row of any bill input belongs to."""
    ids = None
    for name in BILL_INPUTS:
        new = incremental_load(bronze[name], "trans_time", watermarks.get(name))
        new = new.where(F.col("billId").isNotNull()).select("billId")
        ids = new if ids is None else ids.union(new)
    return ids.distinct()


def refreshed_bills(
    bronze: Mapping[str, DataFrame], ids: DataFrame, run_time: dt.datetime
) -> DataFrame:
    """The given bills, assembled anew from all bronze rows that belong to them."""
    part = {n: bronze[n].join(ids, "billId", "left_semi") for n in BILL_INPUTS}
    return silver_bills({**part, "storeDetails": bronze["storeDetails"]}, run_time)


def bills_to_write(silver: DataFrame) -> DataFrame:
    """Bills without a store have no partition to go to and are left out."""
    return silver.where(F.col("storeId").isNotNull())


def silver_items(
    items_bronze: DataFrame, run_time: dt.datetime, watermark: dt.datetime | None = None, by_time: bool = False
) -> DataFrame:
    """New item lines, one per bill, time and item, stamped with the time of the run.

    The same function serves every environment; only the tables differ. With ``by_time``
    the lines lie in ranges of ``createdAt``, for a layout by month.
    """
    new = incremental_load(items_bronze, "load_time", watermark)
    return distinct_items(new, by_time).withColumn("load_time", moment(run_time))
