"""Streams over folders that grow between runs."""

import datetime as dt

from pyspark.sql import functions as F

from billweave.plans import etl
from billweave.schemas import BRONZE, SILVER
from billweave.streaming.pipelines import append_available, daily_sales, first_items, stream_bronze, stream_collection
from billweave.sources.watermark import read_watermark
from tests.test_etl import at, invoice, raw_rows, rows, store, transaction


def add(spark, folder, name, df):
    df.coalesce(1).write.parquet(f"{folder}/{name}")


def test_bronze_stream_takes_each_file_once(spark, folder):
    raw = f"{folder}/raw/invoiceExtractedData/data"

    def run():
        stream_bronze(spark, f"{folder}/raw", folder, "invoiceExtractedData", f"{folder}/checkpoint").awaitTermination()
        return rows(etl.bronze_table(spark, folder, "invoiceExtractedData"), "billId", "billAmount")

    add(spark, raw, "1", raw_rows(spark, "invoiceExtractedData", invoice("1", at(1), "{'value': 1}")))
    assert run() == [("1", 1.0)]
    assert run() == [("1", 1.0)]
    # Loaded late and stamped early: a watermark on load_time would pass it over.
    add(spark, raw, "2", raw_rows(spark, "invoiceExtractedData", invoice("2", at(0), "{'value': 2}")))
    assert run() == [("1", 1.0), ("2", 2.0)]
    assert etl.bronze_table(spark, folder, "invoiceExtractedData").where("trans_time is null").count() == 0


def test_bronze_stream_goes_on_from_the_batch_load(spark, folder):
    for name, first, second in (
        ("billtransactions", transaction("1", at(1), "5"), transaction("2", at(2), "7")),
        ("storeDetails", store("1", "One", at(1)), store("2", "Two", at(2))),
    ):
        raw, key = f"{folder}/raw/{name}/data", "billId" if name == "billtransactions" else "storeId"
        add(spark, raw, "1", raw_rows(spark, name, first))
        etl.load_bronze(spark, f"{folder}/raw", folder, name, at(3))
        later = raw_rows(spark, name, second)
        if name == "billtransactions":
            later = later.withColumn("billAmount", F.col("billAmount").cast("double")).drop("walletAmount")
        add(spark, raw, "2", later)
        for _ in range(2):
            stream_bronze(spark, f"{folder}/raw", folder, name, f"{folder}/checkpoint-{name}", files_per_batch=1).awaitTermination()
            found = etl.bronze_table(spark, folder, name)
            assert rows(found, key) == [("1",), ("2",)] and found.where("trans_time is null").count() == 0
        assert read_watermark(spark, folder, "bronze", name) == at(2)


def test_item_stream_drops_copies(spark, folder):
    schema = BRONZE["items-bronze"]

    def run(batch, lines):
        add(spark, f"{folder}/in", batch, spark.createDataFrame(lines, schema))
        source = stream_collection(spark, f"{folder}/in", schema)
        append_available(first_items(source), f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
        return rows(spark.read.parquet(f"{folder}/out"), "billId", "itemName")

    line = ("1", at(1), "tea", "5", "S1", at(1))
    assert run("1", [line, line, ("1", at(2), "tea", "5", "S1", at(1))]) == [("1", "tea"), ("1", "tea")]
    assert run("2", [line, ("2", at(3), None, "5", "S1", at(3))]) == [("1", "tea"), ("1", "tea"), ("2", None)]


def test_sales_stream_gives_out_finished_days(spark, folder):
    schema = SILVER["all_bills"]

    def run(batch, *bills):
        values = [tuple({"storeId": s, "billAmount": a, "createdAt": t}.get(n) for n in schema.names) for s, a, t in bills]
        add(spark, f"{folder}/in", batch, spark.createDataFrame(values, schema))
        source = stream_collection(spark, f"{folder}/in", schema)
        append_available(daily_sales(source), f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
        return rows(spark.read.parquet(f"{folder}/out"), "date", "storeId", "total_sales")

    first = dt.date(2024, 5, 1)
    assert run("1", ("S1", 1.0, at(9)), ("S1", 2.0, at(9, day=2))) == []
    # Late, but not by more than a day: still counted.
    assert run("2", ("S1", 4.0, at(23)), ("S2", 8.0, at(10)), (None, 3.0, at(10))) == []
    found = run("3", ("S1", 16.0, at(1, day=3)))
    assert sorted(found, key=str) == sorted([(first, "S1", 5.0), (first, "S2", 8.0), (first, None, 3.0)], key=str)
