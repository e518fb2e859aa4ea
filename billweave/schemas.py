"""Schemas of the raw, bronze and silver collections.

Opaque payloads and columns that no operator interprets are kept as strings.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

# Fixed values below: names and types of the collections' columns.
_TYPES = {
    "string": StringType(),
    "double": DoubleType(),
    "long": LongType(),
    "boolean": BooleanType(),
    "date": DateType(),
    "timestamp_ntz": TimestampNTZType(),
}


def _schema(columns: str) -> StructType:
    """A schema from ``name type, ...``; unlike DDL it needs no running session."""
    pairs = (column.split() for column in columns.split(","))
    return StructType([StructField(name, _TYPES[kind]) for name, kind in pairs])


RAW = {
    "storeDetails": _schema(
        "_id string, storeName string, createdAt timestamp_ntz, pincode string, load_time timestamp_ntz"
    ),
    "billRequest": _schema(
        "billId string, _id string, billType string, invocationType string, posId string, "
        "storeId string, mobileNumber string, name string, age string, email string, "
        "gender string, isWidget boolean, createdAt timestamp_ntz, load_time timestamp_ntz"
    ),
    "invoiceExtractedData": _schema(
        "InvoiceTotal string, billId string, tenantId string, _id string, InvoiceId string, "
        "InvoiceDate string, storeId string, createdAt timestamp_ntz, load_time timestamp_ntz, Items string"
    ),
    "receiptExtractedData": _schema(
        "Total string, createdAt timestamp_ntz, load_time timestamp_ntz, storeId string, "
        "tenantId string, billId string, Items string"
    ),
    "billtransactions": _schema(
        "_id string, posId string, storeId string, billId string, custMobile string, dob string, "
        "age string, gender string, email string, name string, billAmount string, billItems string, "
        "paymentMethod string, billDate string, walletAmount string, load_time timestamp_ntz"
    ),
}

BRONZE = {
    "storeDetails": _schema(
        "storeId string, storeName string, onboard_date date, pincode string, "
        "load_time timestamp_ntz, trans_time timestamp_ntz"
    ),
    "billRequest": _schema(
        "billId string, _id string, billType string, invocationType string, posId string, "
        "storeId string, mobileNumber string, name string, age string, email string, "
        "gender string, isWidget boolean, createdAt timestamp_ntz, load_time timestamp_ntz, "
        "trans_time timestamp_ntz"
    ),
    "invoiceExtractedData": _schema(
        "billAmount double, billId string, tenantId string, _id string, InvoiceId string, "
        "InvoiceDate string, storeId string, createdAt timestamp_ntz, load_time timestamp_ntz, "
        "Items string, trans_time timestamp_ntz"
    ),
    "receiptExtractedData": _schema(
        "billAmount double, createdAt timestamp_ntz, load_time timestamp_ntz, storeId string, "
        "tenantId string, billId string, Items string, trans_time timestamp_ntz"
    ),
    "billtransactions": _schema(
        "_id string, posId string, storeId string, billId string, custMobile string, dob string, "
        "age string, gender string, email string, name string, billAmount double, billItems string, "
        "paymentMethod string, billDate string, walletAmount string, load_time timestamp_ntz, "
        "trans_time timestamp_ntz"
    ),
    "items-bronze": _schema(
        "billId string, createdAt timestamp_ntz, itemName string, itemPrice string, "
        "storeId string, load_time timestamp_ntz"
    ),
}

SILVER = {
    "all_bills": _schema(
        "billId string, in_id string, rec_id string, bt_id string, billAmount double, name string, "
        "mobileNumber string, age string, email string, gender string, storeId string, "
        "storeName string, createdAt timestamp_ntz, load_br timestamp_ntz, load_in timestamp_ntz, "
        "load_rec timestamp_ntz, load_bt timestamp_ntz, load_time timestamp_ntz"
    ),
    "all_items": BRONZE["items-bronze"],
}

WATERMARK = _schema("collection string, watermark timestamp_ntz, run_time timestamp_ntz")

LEDGER = _schema("path string, length long, millis long")
