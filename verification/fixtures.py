"""Bills, items and raw collections derived from the driver's tables.

Each view exists twice, as DataFrame code here and as SQL in ``oracle``. Both inject
the NULLs, short numbers, renamed customers and bad prices the metrics must handle.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from billweave.streaming.pipelines import stream_collection

AS_OF = dt.date(2001, 8, 1)
EVENTS_AS_OF = dt.date(2024, 1, 30)
RUN_TIME = dt.datetime(2001, 8, 2, 6, 30)
ITEMS_WATERMARK = dt.datetime(2001, 7, 1)

# Raw rows are delivered in two batches, cut by their load time, and loaded by two runs.
BATCH_CUT = dt.datetime(2000, 1, 1)
FIRST_RUN = dt.datetime(2001, 8, 2, 6, 30)
SECOND_RUN = dt.datetime(2001, 8, 2, 6, 45)


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; its schema is read from the file once per process."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def _after(time: Column, seconds: Column) -> Column:
    return time + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def _store_id() -> Column:
    store = F.concat(F.lit("S"), (F.col("o_orderkey") % 8).cast("string"))
    return F.when(F.col("o_orderkey") % 97 != 0, store)


def _mobile() -> Column:
    number = F.concat(F.lit("9"), F.lpad(F.col("o_custkey").cast("string"), 9, "0"))
    return F.when(F.col("o_custkey") % 17 == 0, None).when(F.col("o_custkey") % 13 == 0, "12345").otherwise(number)


def _created_at() -> Column:
    return _after(F.col("o_orderdate"), F.col("o_orderkey") % 86400)


def bills(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    joined = table(spark, sf_dir, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
    return joined.select(
        F.col("o_orderkey").cast("string").alias("billId"),
        _store_id().alias("storeId"),
        _mobile().alias("mobileNumber"),
        F.when(F.col("o_orderkey") % 5 == 0, F.upper("c_name")).otherwise(F.col("c_name")).alias("name"),
        F.when(F.col("o_orderkey") % 31 != 0, F.col("o_totalprice")).alias("billAmount"),
        _created_at().alias("createdAt"),
    )


def bills_of_events(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_id").cast("string").alias("billId"),
        F.concat(F.lit("S"), (F.col("event_id") % 8).cast("string")).alias("storeId"),
        F.concat(F.lit("9"), F.lpad(F.col("user_id").cast("string"), 9, "0")).alias("mobileNumber"),
        F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("name"),
        F.col("value").alias("billAmount"),
        F.col("ts").alias("createdAt"),
    )


def bills_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bills_of_events(table(spark, sf_dir, "events"))


def items(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """Item lines; ``lines`` may be a stream of them."""
    lines = table(spark, sf_dir, "lineitem") if lines is None else lines
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", _store_id().alias("storeId"), _created_at().alias("createdAt")
    )
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    line, item = F.col("l_linenumber"), F.col("l_partkey")
    joined = (
        lines.select("l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice")
        .join(part, item == F.col("p_partkey"), "left")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    )
    return joined.select(
        F.col("o_orderkey").cast("string").alias("billId"),
        "storeId",
        "createdAt",
        F.when(item % 41 == 0, "")
        .when(item % 43 == 0, "None")
        .when(item % 47 != 0, F.col("p_name"))
        .alias("itemName"),
        F.when(line == 7, "N/A")
        .otherwise(F.col("l_extendedprice").cast("decimal(12,2)").cast("string"))
        .alias("itemPrice"),
        _after(F.col("createdAt"), line * 60).alias("load_time"),
    )


def _bill_request_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bills, those of urgent orders requested a second time two hours later."""
    copies = F.when(F.col("o_orderpriority") == "1-URGENT", F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return (
        table(spark, sf_dir, "orders")
        .withColumn("copy", F.explode(copies))
        .join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
    )


def raw_bill_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey").cast("string")
    return _bill_request_copies(spark, sf_dir).select(
        key.alias("billId"),
        F.concat(F.lit("r"), key, F.lit("-"), F.col("copy").cast("string")).alias("_id"),
        F.lower("o_orderstatus").alias("billType"),
        F.lower("c_mktsegment").alias("invocationType"),
        F.col("o_orderpriority").alias("posId"),
        _store_id().alias("storeId"),
        _mobile().alias("mobileNumber"),
        F.when(F.col("copy") == 1, F.upper("c_name")).otherwise(F.col("c_name")).alias("name"),
        (F.lit(18) + F.col("o_custkey") % 70).cast("string").alias("age"),
        F.concat(F.lit("c"), F.col("o_custkey").cast("string"), F.lit("@example.org")).alias("email"),
        F.when(F.col("o_custkey") % 3 == 0, "f").when(F.col("o_custkey") % 3 == 1, "m").alias("gender"),
        (F.col("copy") == 1).alias("isWidget"),
        _created_at().alias("createdAt"),
        _after(_created_at(), F.lit(3600) + F.col("copy") * 7200).alias("load_time"),
    )


def _late(seconds: int) -> Column:
    """Load time of an extraction, two days later for orders of high priority."""
    delay = F.when(F.col("o_orderpriority") == "2-HIGH", 172800).otherwise(0)
    return _after(_created_at(), F.lit(seconds) + delay)


def _printed_total(amount: Column) -> Column:
    return F.concat(F.lit("{'value': "), amount.cast("decimal(14,2)").cast("string"), F.lit(", 'x': None}"))


def raw_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extracted invoices of finished orders; low priority ones lack the amount."""
    key = F.col("o_orderkey").cast("string")
    missing = F.lit("{'value': None}")
    return (
        table(spark, sf_dir, "orders")
        .where("o_orderstatus = 'F'")
        .select(
            F.when(F.col("o_orderpriority") == "5-LOW", missing)
            .otherwise(_printed_total(F.col("o_totalprice")))
            .alias("InvoiceTotal"),
            key.alias("billId"),
            F.lit("t").alias("tenantId"),
            F.concat(F.lit("i"), key).alias("_id"),
            F.concat(F.lit("INV-"), key).alias("InvoiceId"),
            F.to_date("o_orderdate").cast("string").alias("InvoiceDate"),
            _store_id().alias("storeId"),
            _created_at().alias("createdAt"),
            _late(3600).alias("load_time"),
            F.lit("[]").alias("Items"),
        )
    )


def raw_receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extracted receipts of finished and pending orders; others have none yet."""
    return receipts_of(table(spark, sf_dir, "orders").where("o_orderstatus in ('F', 'P')"))


def all_raw_receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return receipts_of(table(spark, sf_dir, "orders"))


def receipts_of(orders: DataFrame) -> DataFrame:
    """Receipts one unit above the order total."""
    return (
        orders.select(
            _printed_total(F.col("o_totalprice") + 1).alias("Total"),
            _created_at().alias("createdAt"),
            _late(5400).alias("load_time"),
            _store_id().alias("storeId"),
            F.lit("t").alias("tenantId"),
            F.col("o_orderkey").cast("string").alias("billId"),
            F.lit("[]").alias("Items"),
        )
    )


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions of all but medium priority orders; these were not paid by card."""
    return transactions_of(table(spark, sf_dir, "orders").where("o_orderpriority <> '3-MEDIUM'"))


def all_raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions_of(table(spark, sf_dir, "orders"))


def transactions_of(orders: DataFrame) -> DataFrame:
    """Transactions two units above the order total."""
    key = F.col("o_orderkey").cast("string")
    nothing = F.lit(None).cast("string")
    return (
        orders.select(
            F.concat(F.lit("t"), key).alias("_id"),
            F.col("o_orderpriority").alias("posId"),
            _store_id().alias("storeId"),
            key.alias("billId"),
            _mobile().alias("custMobile"),
            nothing.alias("dob"),
            nothing.alias("age"),
            nothing.alias("gender"),
            nothing.alias("email"),
            F.lit("buyer").alias("name"),
            (F.col("o_totalprice") + 2).cast("decimal(14,2)").cast("string").alias("billAmount"),
            F.lit("[]").alias("billItems"),
            F.lower("o_orderstatus").alias("paymentMethod"),
            F.to_date("o_orderdate").cast("string").alias("billDate"),
            F.lit("0").alias("walletAmount"),
            _late(7200).alias("load_time"),
        )
    )


def raw_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stores from suppliers, numbered from S1, so bills of S0 find no match."""
    opened = F.lit("1994-12-01").cast("date")
    created = F.date_add(opened, F.col("s_nationkey")).cast("timestamp_ntz")
    return (
        table(spark, sf_dir, "supplier")
        .select(
            F.concat(F.lit("S"), (F.col("s_suppkey") + 1).cast("string")).alias("_id"),
            F.col("s_name").alias("storeName"),
            created.alias("createdAt"),
            F.lpad(F.col("s_nationkey").cast("string"), 6, "0").alias("pincode"),
            created.alias("load_time"),
        )
    )


RAW_COLLECTIONS = {
    "billRequest": raw_bill_requests,
    "invoiceExtractedData": raw_invoices,
    "receiptExtractedData": raw_receipts,
    "billtransactions": raw_transactions,
    "storeDetails": raw_stores,
}


def deliver(spark: SparkSession, sf_dir: str, folder: str, second: bool) -> None:
    """Write one batch of every raw collection below ``folder``."""
    for name, make in RAW_COLLECTIONS.items():
        late = F.col("load_time") > F.lit(BATCH_CUT.isoformat(sep=" ")).cast("timestamp_ntz")
        batch = make(spark, sf_dir).where(late if second else ~late)
        batch.write.parquet(f"{folder}/{name}/data/{'second' if second else 'first'}")


def raw_event_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return invoices_of_events(table(spark, sf_dir, "events"))


def raw_event_invoice_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    return invoices_of_events(stream_collection(spark, sf_dir, schema, files="events.parquet"))


def invoices_of_events(events: DataFrame) -> DataFrame:
    """Extracted invoices whose amount text is made from event properties.

    Errors carry a text amount, searches a quoted number and purchases an apostrophe
    that breaks the text.
    """
    k = F.get_json_object("props", "$.k")
    text = (
        F.when(F.col("event_type") == "error", F.concat(F.lit("{'value': 'k"), k, F.lit("'}")))
        .when(F.col("event_type") == "view", F.concat(F.lit("{'value': '"), k, F.lit(".5'}")))
        .when(F.col("event_type") == "purchase", F.concat(F.lit("{'value': "), k, F.lit(", 'n': 'O'Neil'}")))
        .otherwise(F.concat(F.lit("{'value': "), k, F.lit(", 'x': None}")))
    )
    key = F.col("event_id").cast("string")
    return events.select(
        text.alias("InvoiceTotal"),
        key.alias("billId"),
        F.col("event_type").alias("tenantId"),
        F.concat(F.lit("e"), key).alias("_id"),
        F.concat(F.lit("INV-"), key).alias("InvoiceId"),
        F.to_date("ts").cast("string").alias("InvoiceDate"),
        F.concat(F.lit("S"), (F.col("event_id") % 8).cast("string")).alias("storeId"),
        F.col("ts").alias("createdAt"),
        _after(F.col("ts"), F.lit(3600)).alias("load_time"),
        F.lit("[]").alias("Items"),
    )


def item_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The item lines, read as a stream of files."""
    schema = table(spark, sf_dir, "lineitem").schema
    return items(spark, sf_dir, stream_collection(spark, sf_dir, schema, files="lineitem.parquet"))


def event_bill_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bills made from events, read as a stream of files."""
    schema = table(spark, sf_dir, "events").schema
    events = stream_collection(spark, sf_dir, schema, files="events.parquet")
    return bills_of_events(events)
