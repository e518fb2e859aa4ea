"""The registered queries: every metric and load step over the driver's tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, StructType

from billweave.functions.calendar import MONTH_FOLDER
from billweave.operators import bronze, silver
from billweave.operators.incremental import incremental_load, is_up_to_date, max_timestamp, moment
from billweave.operators.segments import rfm_segments
from billweave.plans import etl
from billweave.plans.publishing import silver_bills_table, silver_items_table
from billweave.plans.registry import BILLS, ITEMS, METRICS
from billweave.schemas import BRONZE, WATERMARK
from billweave.sinks.parquet import publish
from billweave.sources.parquet import read_partitioned, read_union_by_name
from billweave.sources.watermark import advance_watermark, watermark_path
from billweave.staging import new_folder, staged
from billweave.streaming.pipelines import append_available, daily_sales, first_items, sales_so_far, stream_bronze
from verification import fixtures

Query = Callable[[SparkSession, str], DataFrame]

# Sums of money are compared in cents, other doubles to six places, dates as ISO text.
_MONEY = {
    "total_sales", "total_spend", "monetary", "total_amount_spent", "product_sale",
}

# Metrics by hour use the events, whose times cover the whole day.
ON_EVENTS = {"avg_hourly_billing_trend", "sales_trend_date_hour", "visitor_trend_date_hour"}
ALSO_ON_EVENTS = {"bill_count_windows", "sales_windows", "customer_visit_windows_dev"}


def _comparable(df: DataFrame) -> DataFrame:
    columns = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if field.name == "item_combination":
            column = F.to_json(column).alias(field.name)
        elif isinstance(field.dataType, DateType):
            column = column.cast("string").alias(field.name)
        elif isinstance(field.dataType, DoubleType) and field.name not in ("billAmount",):
            cents = field.name in _MONEY or field.name.startswith("sales_")
            column = F.round(column, 2 if cents else 6).alias(field.name)
        columns.append(column)
    return df.select(*columns)


def _metric(name: str, on_events: bool = False) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        metric = METRICS[name]
        as_of = fixtures.EVENTS_AS_OF if on_events else fixtures.AS_OF
        bills = fixtures.bills_from_events if on_events else fixtures.bills
        tables = {
            BILLS: lambda: bills(spark, sf_dir),
            ITEMS: lambda: fixtures.items(spark, sf_dir),
            "segments": lambda: rfm_segments(bills(spark, sf_dir), as_of),
        }
        return _comparable(metric(*[tables[i]() for i in metric.inputs], as_of=as_of))

    return query


def _bronze(extract: Callable[[DataFrame], DataFrame], raw: Query) -> Query:
    return lambda spark, sf_dir: _comparable(extract(raw(spark, sf_dir)))


def _bronze_inputs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Bronze tables as if loaded once a day, on the midnight after the load time."""
    night = F.date_add(F.to_date("load_time"), 1).cast("timestamp_ntz")
    return {
        name: bronze.BRONZE_EXTRACTORS[name](make(spark, sf_dir)).withColumn("trans_time", night)
        for name, make in fixtures.RAW_COLLECTIONS.items()
    }


def _silver_bills(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_bills(_bronze_inputs(spark, sf_dir), fixtures.RUN_TIME)


def _silver_bills_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    watermarks = dict.fromkeys(silver.BILL_INPUTS, fixtures.BATCH_CUT)
    return silver.silver_bills(_bronze_inputs(spark, sf_dir), fixtures.RUN_TIME, watermarks)


def _silver_bills_upserted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries, each loaded to bronze and merged into silver bills."""
    base = new_folder(spark, "upsert")
    return _loaded_twice(spark, sf_dir, base, etl.upsert_silver_bills, etl.upsert_silver_bills)


def _loaded_twice(spark: SparkSession, sf_dir: str, base: str, *loads: Callable) -> DataFrame:
    runs = (False, fixtures.FIRST_RUN), (True, fixtures.SECOND_RUN)
    for (second, run_time), load in zip(runs, loads, strict=True):
        fixtures.deliver(spark, sf_dir, f"{base}/raw", second)
        etl.load_all_bronze(spark, f"{base}/raw", base, run_time)
        load(spark, base, run_time)
    return silver_bills_table(spark, base).drop(MONTH_FOLDER)


def _silver_bills_appended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries, appended one after the other."""
    base = new_folder(spark, "append")
    return _loaded_twice(spark, sf_dir, base, etl.append_silver_bills, etl.append_silver_bills)


def _silver_bills_append_then_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = new_folder(spark, "append-upsert")
    return _loaded_twice(spark, sf_dir, base, etl.append_silver_bills, etl.upsert_silver_bills)


def _watermarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The watermarks a load of silver bills leaves behind."""
    base = new_folder(spark, "watermarks")
    loaded = staged(_silver_bills(spark, sf_dir), "loaded")
    requests = _bronze_inputs(spark, sf_dir)["billRequest"]
    advance_watermark(requests, base, "silver", "billRequest", "trans_time", fixtures.RUN_TIME)
    for name, (id_name, load_name) in silver.EXTRACTIONS.items():
        advance_watermark(loaded, base, "silver", name, load_name, fixtures.RUN_TIME, known=id_name)
    paths = [watermark_path(base, "silver", name) for name in silver.BILL_INPUTS]
    return spark.read.schema(WATERMARK).parquet(*paths).select("collection", "watermark", "run_time")


def _published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily sales, published by store and read back from the folders."""
    path = new_folder(spark, "published")
    publish(METRICS["daily_sales_trend"](fixtures.bills(spark, sf_dir)), path)
    return _comparable(read_partitioned(spark, path, {"storeId": "string"}))


def _union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bills kept in two datasets: finished orders have narrow keys and lack the priority."""
    path = new_folder(spark, "drifted")
    orders = fixtures.table(spark, sf_dir, "orders")
    finished = orders.where("o_orderstatus = 'F'").withColumn("o_orderkey", F.col("o_orderkey").cast("int"))
    finished.drop("o_orderpriority").write.parquet(f"{path}/finished")
    orders.where("o_orderstatus <> 'F'").write.parquet(f"{path}/open")
    return read_union_by_name(spark, [f"{path}/finished", f"{path}/open"])


def _union_by_name_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of one folder: without the priority, with the total as number and as broken text."""
    path = new_folder(spark, "drifted-files")
    orders = fixtures.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority", "o_orderstatus")
    write = lambda df: df.write.mode("append").parquet(path)
    write(orders.where("o_orderstatus = 'F'").drop("o_orderpriority").withColumn("o_orderkey", F.col("o_orderkey").cast("int")))
    write(orders.where("o_orderstatus = 'P'").withColumn("o_totalprice", F.lit("abc")))
    write(orders.where("o_orderstatus not in ('F', 'P')"))
    declared = StructType().add("o_orderkey", orders.schema["o_orderkey"].dataType).add("o_totalprice", "double")
    return read_union_by_name(spark, [path], declared)


def _silver_items_drifted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Priced lines have the price as a number, the others a note; both in one folder."""
    path = new_folder(spark, "drifted-items")
    lines = fixtures.items(spark, sf_dir)
    priced = lines.where("itemPrice <> 'N/A'").withColumn("itemPrice", F.col("itemPrice").cast("decimal(12,2)"))
    priced.write.mode("append").parquet(path)
    lines.where("itemPrice = 'N/A'").withColumn("note", F.lit("unpriced")).write.mode("append").parquet(path)
    rows = read_union_by_name(spark, [path], BRONZE["items-bronze"])
    return silver.silver_items(rows, fixtures.RUN_TIME)


def _silver_items_environments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The item load in two environments, each in its own folder.

    The lines are made for the first; the second gets a copy of its files' rows.
    """
    found, lines = None, fixtures.items(spark, sf_dir)
    for env in ("dev", "prod"):
        base = new_folder(spark, f"items-{env}")
        raw = f"{base}/bronze/items-bronze/data/first"
        lines.write.parquet(raw)
        lines = spark.read.schema(lines.schema).parquet(raw)
        etl.load_silver_items(spark, base, fixtures.RUN_TIME)
        rows = silver_items_table(spark, base).drop(MONTH_FOLDER).withColumn("env", F.lit(env))
        found = rows if found is None else found.union(rows)
    return found


def _up_to_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the bills count as loaded for watermarks around their newest time."""
    bills = fixtures.bills(spark, sf_dir)
    newest = max_timestamp(bills)
    rows = [(s, is_up_to_date(bills, newest + dt.timedelta(seconds=s))) for s in (-60, -40, 0, 40, 60)]
    return spark.createDataFrame(rows, "seconds_off int, up_to_date boolean")


def _stream_bronze_after_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One delivery by the batch load, the next by the stream, into one table."""
    base = new_folder(spark, "stream-after-batch")
    fixtures.deliver(spark, sf_dir, f"{base}/raw", second=False)
    etl.load_bronze(spark, f"{base}/raw", base, "billtransactions", fixtures.FIRST_RUN)
    fixtures.deliver(spark, sf_dir, f"{base}/raw", second=True)
    stream_bronze(spark, f"{base}/raw", base, "billtransactions", new_folder(spark, "stream-state")).awaitTermination()
    return etl.bronze_table(spark, base, "billtransactions").select("billId", "billAmount")


def _set_back(spark: SparkSession, path: str, hours: int) -> None:
    """Give all files below a folder an earlier time of change, as a late commit leaves them."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = files.listFiles(folder, True)
    while found.hasNext():
        status = found.next()
        files.setTimes(status.getPath(), status.getModificationTime() - hours * 3_600_000, -1)


def _bronze_late_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries; the files of the second are older than those of the first."""
    base = new_folder(spark, "late-commit")
    for second, run_time in ((False, fixtures.FIRST_RUN), (True, fixtures.SECOND_RUN)):
        fixtures.deliver(spark, sf_dir, f"{base}/raw", second)
        if second:
            _set_back(spark, f"{base}/raw/billtransactions/data/second", 48)
        etl.load_bronze(spark, f"{base}/raw", base, "billtransactions", run_time)
    return etl.bronze_table(spark, base, "billtransactions").select("billId", "billAmount")


def _silver_items_late_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item lines in two folders by load time; the files of the later lines are older."""
    base = new_folder(spark, "late-items")
    path, lines = f"{base}/bronze/items-bronze/data", fixtures.items(spark, sf_dir)
    later = F.col("load_time") > moment(fixtures.ITEMS_WATERMARK)
    for name, part, run_time in (("first", ~later, fixtures.FIRST_RUN), ("second", later, fixtures.SECOND_RUN)):
        lines.where(part).write.parquet(f"{path}/{name}")
        if name == "second":
            _set_back(spark, f"{path}/{name}", 48)
        etl.load_silver_items(spark, base, run_time)
    return silver_items_table(spark, base).drop(MONTH_FOLDER)


def _stream_daily_sales_so_far(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The days the stream has given out, and the last ones out of its state."""
    path, checkpoint = new_folder(spark, "stream-sales"), new_folder(spark, "stream-sales-checkpoint")
    sales = daily_sales(fixtures.event_bill_stream(spark, sf_dir))
    append_available(sales, path, checkpoint).awaitTermination()
    return _comparable(sales_so_far(spark, path, checkpoint))


def _silver_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_items(fixtures.items(spark, sf_dir), fixtures.RUN_TIME).select(
        "billId", "createdAt", "itemName", "itemPrice", "storeId", "load_time"
    )


def _incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental_load(fixtures.items(spark, sf_dir), "load_time", fixtures.ITEMS_WATERMARK)


def _unreadable(spark: SparkSession, sf_dir: str) -> DataFrame:
    broken = bronze.unreadable_amounts(fixtures.raw_event_invoices(spark, sf_dir), "InvoiceTotal")
    return broken.groupBy("tenantId").agg(F.count(F.lit(1)).alias("invoices"))


def _streamed(spark: SparkSession, name: str, rows: DataFrame) -> DataFrame:
    """Run a stream over everything there is and read back what it wrote."""
    path = new_folder(spark, name)
    append_available(rows, path, new_folder(spark, f"{name}-checkpoint")).awaitTermination()
    return spark.read.schema(rows.schema).parquet(path)


def _stream_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    invoices = bronze.bronze_invoices(fixtures.raw_event_invoice_stream(spark, sf_dir))
    return _comparable(_streamed(spark, "stream-bronze", invoices))


def _stream_first_bills(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item lines whose copies have the same time."""
    first = _streamed(spark, "stream-items", first_items(fixtures.item_stream(spark, sf_dir)))
    return first.select("billId", "createdAt", "itemName")


def _stream_daily_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = daily_sales(fixtures.event_bill_stream(spark, sf_dir))
    return _comparable(_streamed(spark, "stream-sales", sales))


def queries() -> dict[str, Query]:
    found = {name: _metric(name, name in ON_EVENTS) for name in METRICS}
    found |= {f"{name}_events": _metric(name, True) for name in sorted(ALSO_ON_EVENTS)}
    return found | {
        "bronze_stores": _bronze(bronze.bronze_stores, fixtures.raw_stores),
        "bronze_bill_requests": _bronze(bronze.bronze_bill_requests, fixtures.raw_bill_requests),
        "bronze_invoices": _bronze(bronze.bronze_invoices, fixtures.raw_event_invoices),
        "bronze_invoices_unreadable": _unreadable,
        "bronze_receipts": _bronze(bronze.bronze_receipts, fixtures.all_raw_receipts),
        "bronze_transactions": _bronze(bronze.bronze_transactions, fixtures.all_raw_transactions),
        "silver_bills_full": _silver_bills,
        "silver_bills_incremental": _silver_bills_incremental,
        "silver_bills_upserted": _silver_bills_upserted,
        "silver_bills_appended": _silver_bills_appended,
        "silver_bills_append_then_upsert": _silver_bills_append_then_upsert,
        "silver_items_drifted": _silver_items_drifted,
        "silver_items_environments": _silver_items_environments,
        "union_by_name_files": _union_by_name_files,
        "up_to_date_check": _up_to_date,
        "stream_bronze_after_batch": _stream_bronze_after_batch,
        "silver_watermarks": _watermarks,
        "published_daily_sales": _published,
        "union_by_name_scan": _union_by_name,
        "silver_items_dedupe": _silver_items,
        "incremental_filter": _incremental,
        "stream_bronze_invoices": _stream_bronze,
        "stream_first_items": _stream_first_bills,
        "stream_daily_sales": _stream_daily_sales,
        "stream_daily_sales_so_far": _stream_daily_sales_so_far,
        "bronze_late_commit": _bronze_late_commit,
        "silver_items_late_commit": _silver_items_late_commit,
    }
