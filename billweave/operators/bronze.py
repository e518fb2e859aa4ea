"""Raw collections to bronze: projections, renames and amounts out of printed text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billweave.functions.amounts import amount_unreadable, extracted_amount, to_amount
from billweave.schemas import BRONZE

_STAMP = "trans_time"


def _project(raw: DataFrame, collection: str, **computed) -> DataFrame:
    names = [c for c in BRONZE[collection].names if c != _STAMP]
    return raw.select(*[computed[c].alias(c) if c in computed else F.col(c) for c in names])


def bronze_stores(raw: DataFrame) -> DataFrame:
    return _project(raw, "storeDetails", storeId=F.col("_id"), onboard_date=F.to_date("createdAt"))


def bronze_bill_requests(raw: DataFrame) -> DataFrame:
    return _project(raw, "billRequest")


def bronze_invoices(raw: DataFrame) -> DataFrame:
    return _project(raw, "invoiceExtractedData", billAmount=extracted_amount(F.col("InvoiceTotal")))


def bronze_receipts(raw: DataFrame) -> DataFrame:
    return _project(raw, "receiptExtractedData", billAmount=extracted_amount(F.col("Total")))


def bronze_transactions(raw: DataFrame) -> DataFrame:
    return _project(raw, "billtransactions", billAmount=to_amount(F.col("billAmount").cast("string")))


def unreadable_amounts(raw: DataFrame, text_column: str) -> DataFrame:
    """Raw rows whose amount text cannot be read; their bronze amount is NULL."""
    return raw.where(amount_unreadable(F.col(text_column)))


BRONZE_EXTRACTORS = {
    "storeDetails": bronze_stores,
    "billRequest": bronze_bill_requests,
    "invoiceExtractedData": bronze_invoices,
    "receiptExtractedData": bronze_receipts,
    "billtransactions": bronze_transactions,
}
