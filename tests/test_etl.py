"""Raw to bronze to silver on folders, with late, repeated and broken rows."""

import datetime as dt
import os
import re
import shutil
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from billweave import versions
from billweave.operators import bronze as bronze_operators
from billweave.operators.incremental import incremental_load, is_up_to_date, max_timestamp, run_minute
from billweave.plans import etl
from billweave.plans.publishing import silver_bills_table, silver_items_table
from billweave.schemas import BRONZE, RAW, SILVER
from billweave.sinks.parquet import append_batch, append_stamped, publish
from billweave.sources import parquet
from billweave.sources.ledger import ledger_path, read_ledger, unread_files
from billweave.sources.parquet import data_files, read_collection, read_partitioned, read_union_by_name
from billweave.sources.watermark import (
    KEPT_ROWS,
    last_run,
    parse_watermark,
    read_watermark,
    write_watermark,
)
from tests.test_plans import plan_of


def at(hour, minute=0, day=1):
    return dt.datetime(2024, 5, day, hour, minute)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def raw_rows(spark, collection, *values):
    schema = RAW[collection]
    return spark.createDataFrame([tuple(v.get(n) for n in schema.names) for v in values], schema)


def request(bill, load, store="S1", day=1, name="Ann"):
    return {
        "billId": bill, "_id": f"r{bill}{load}", "storeId": store, "mobileNumber": "9000000001",
        "name": name, "createdAt": at(9, day=day), "load_time": load,
    }


def invoice(bill, load, total):
    return {"billId": bill, "InvoiceTotal": total, "load_time": load, "createdAt": load}


def receipt(bill, load, total):
    return {"billId": bill, "Total": total, "load_time": load, "createdAt": load}


def transaction(bill, load, amount):
    return {"billId": bill, "_id": f"t{bill}", "billAmount": amount, "load_time": load}


def store(key, name, load):
    return {"_id": key, "storeName": name, "createdAt": at(0), "load_time": load}


COLLECTIONS = ("billRequest", "invoiceExtractedData", "receiptExtractedData", "billtransactions", "storeDetails")


def add_raw(spark, folder, batch, **by_collection):
    for name in COLLECTIONS:
        values = by_collection.get(name, [])
        raw_rows(spark, name, *values).coalesce(1).write.parquet(f"{folder}/raw/{name}/data/{batch}")


@pytest.mark.parametrize(
    "text, amount, unreadable",
    [
        ("{'value': 12.5, 'x': None}", 12.5, False),
        ("{'value': '12.5'}", 12.5, False),
        ("{'value': None}", None, False),
        ("{'x': 1}", None, False),
        (None, None, False),
        ("{'value': 'abc'}", None, True),
        ("{'value': '5d'}", None, True),
        ("{'value': 1, 'n': 'O'Neil'}", None, True),
        ("", None, True),
        ("{'value': -3}", -3.0, False),
        ("{'value': 1e3}", 1000.0, False),
    ],
)
def test_amount_text(spark, text, amount, unreadable):
    raw = raw_rows(spark, "invoiceExtractedData", invoice("1", at(1), text))
    assert bronze_operators.bronze_invoices(raw).first()["billAmount"] == amount
    assert bronze_operators.unreadable_amounts(raw, "InvoiceTotal").count() == unreadable
    raw = raw_rows(spark, "receiptExtractedData", receipt("1", at(1), text))
    assert bronze_operators.bronze_receipts(raw).first()["billAmount"] == amount


def test_bronze_schemas(spark):
    for name, extract in bronze_operators.BRONZE_EXTRACTORS.items():
        out = extract(raw_rows(spark, name))
        expected = [(f.name, f.dataType) for f in BRONZE[name].fields if f.name != "trans_time"]
        assert [(f.name, f.dataType) for f in out.schema.fields] == expected


def test_incremental_is_strict(spark):
    df = raw_rows(spark, "storeDetails", store("S1", "a", at(1)), store("S2", "b", at(2)), store("S3", "c", at(3)))
    assert rows(incremental_load(df, "load_time", at(2)), "_id") == [("S3",)]
    assert incremental_load(df, "load_time", None).count() == 3
    assert max_timestamp(df, "load_time") == at(3)
    assert max_timestamp(df.where("false"), "load_time") is None


def test_up_to_date_tolerance(spark):
    df = raw_rows(spark, "storeDetails", {"createdAt": at(5)})
    assert is_up_to_date(df, at(5) + dt.timedelta(seconds=59))
    assert is_up_to_date(df, at(5) - dt.timedelta(seconds=59))
    assert not is_up_to_date(df, at(5) + dt.timedelta(seconds=60))
    assert not is_up_to_date(df, None)
    assert not is_up_to_date(df.where("false"), at(5))


def test_up_to_date_source_is_skipped(spark, folder):
    raw = f"{folder}/raw"
    row = {**request("1", at(1)), "createdAt": at(1)}
    add_raw(spark, folder, "1", billRequest=[row])
    assert etl.load_bronze(spark, raw, folder, "billRequest", at(3)) == at(1)
    add_raw(spark, folder, "2", billRequest=[{**row, "load_time": at(2)}])
    assert etl.load_bronze(spark, raw, folder, "billRequest", at(4), skip_if_up_to_date=True) is None
    assert etl.load_bronze(spark, raw, folder, "billRequest", at(4)) == at(2)


def test_watermark_round_trip(spark, folder):
    assert read_watermark(spark, folder, "bronze", "x") is None
    write_watermark(spark, folder, "bronze", "x", at(3), at(9))
    write_watermark(spark, folder, "bronze", "x", at(4), at(10))
    assert read_watermark(spark, folder, "bronze", "x") == at(4)
    assert last_run(spark, folder, "bronze", "x") == at(10)
    assert parse_watermark("2024-05-01 04:00:00\n") == at(4)
    assert run_minute(dt.datetime(2024, 5, 1, 4, 5, 59, 999)) == at(4, 5)


def test_union_by_name_widens_and_fills(spark, folder):
    spark.range(2).select(F.col("id").cast("int").alias("a"), F.lit("x").alias("b")).write.parquet(f"{folder}/1")
    spark.range(2, 4).select(F.lit(1.5).alias("c"), F.col("id").alias("a")).write.parquet(f"{folder}/2")
    spark.range(4, 5).select(F.col("id").cast("int").alias("a"), F.lit("y").alias("b")).write.parquet(f"{folder}/3")
    df = read_union_by_name(spark, [f"{folder}/{i}" for i in (1, 2, 3)])
    assert dict(df.dtypes) == {"a": "bigint", "b": "string", "c": "double"}
    assert rows(df, "a", "b", "c") == [
        (0, "x", None), (1, "x", None), (2, None, 1.5), (3, None, 1.5), (4, "y", None),
    ]


def test_transactions_of_drifted_batches(spark, folder):
    path = f"{folder}/raw/billtransactions/data"
    first = raw_rows(spark, "billtransactions", transaction("1", at(1), "12.5"))
    first.drop("walletAmount", "dob").write.parquet(f"{path}/a")
    second = raw_rows(spark, "billtransactions", transaction("2", at(2), "7"), transaction("3", at(2), None))
    second.withColumn("billAmount", F.col("billAmount").cast("double")).write.parquet(f"{path}/b")
    assert etl.load_bronze(spark, f"{folder}/raw", folder, "billtransactions", at(3)) == at(2)
    found = etl.bronze_table(spark, folder, "billtransactions")
    assert rows(found, "billId", "billAmount", "dob") == [("1", 12.5, None), ("2", 7.0, None), ("3", None, None)]


def test_publish_replaces_only_written_partitions(spark, folder):
    path = f"{folder}/kpi"
    first = spark.createDataFrame([("0012", 1), ("0012", 2), ("7", 3), (None, 4)], "storeId string, v int")
    publish(first, path, order=[F.col("v").desc()])
    publish(spark.createDataFrame([("0012", 9)], "storeId string, v int"), path)
    back = read_partitioned(spark, path, {"storeId": "string"})
    assert back.columns == ["v", "storeId"]
    assert rows(back, "storeId", "v") == [("0012", 9), ("7", 3), (None, 4)]


def test_appends(spark, folder):
    df = spark.createDataFrame(
        [("S1", 1, at(1)), (None, 2, at(1))], "storeId string, v int, createdAt timestamp_ntz"
    )
    for _ in range(2):  # the same minute again replaces the batch
        append_batch(df, f"{folder}/a", at(1))
        append_stamped(df.withColumn("trans_time", F.lit(at(1).isoformat()).cast("timestamp_ntz")), f"{folder}/c")
    append_batch(df, f"{folder}/a", at(2))
    assert read_collection(spark, f"{folder}/a", df.schema).count() == 4
    stamped = read_partitioned(spark, f"{folder}/c", {"trans_time": "timestamp_ntz"})
    assert rows(stamped.select("trans_time").distinct(), "trans_time") == [(at(1),)]


def test_bronze_load_is_incremental(spark, folder):
    raw, base = f"{folder}/raw", f"{folder}/base"
    add_raw(spark, folder, "1", billRequest=[request("1", at(1)), request("2", at(2))], storeDetails=[store("S1", "One", at(1))])
    marks = etl.load_all_bronze(spark, raw, base, at(3))
    assert marks["billRequest"] == at(2) and marks["invoiceExtractedData"] is None
    assert etl.load_bronze(spark, raw, base, "billRequest", at(4)) is None
    add_raw(spark, folder, "2", billRequest=[request("3", at(2)), request("4", at(5))])
    assert etl.load_bronze(spark, raw, base, "billRequest", at(6)) == at(5)
    assert etl.load_bronze(spark, raw, base, "billRequest", at(6)) is None
    add_raw(spark, folder, "3", billRequest=[request("5", at(6))])
    with pytest.raises(ValueError):
        etl.load_bronze(spark, raw, base, "billRequest", at(6))
    found = etl.bronze_table(spark, base, "billRequest")
    assert rows(found, "billId", "trans_time") == [("1", at(3)), ("2", at(3)), ("4", at(6))]
    assert rows(etl.bronze_table(spark, base, "storeDetails"), "storeId", "onboard_date") == [("S1", dt.date(2024, 5, 1))]


BATCHES = [
    {
        "billRequest": [request("1", at(1)), request("2", at(1)), request("3", at(1), store=None), request("4", at(1), day=3)],
        "invoiceExtractedData": [invoice("1", at(1), "{'value': 10}"), invoice("9", at(1), "{'value': 90}")],
        "receiptExtractedData": [receipt("1", at(1), "{'value': 11}"), receipt("2", at(1), "{'value': 21}")],
        "billtransactions": [transaction("4", at(1), "42")],
        "storeDetails": [store("S1", "Old", at(1))],
    },
    {
        "billRequest": [request("1", at(4), store="S2", name="Bob"), request("9", at(4)), request("3", at(4), store="S3")],
        "invoiceExtractedData": [invoice("2", at(4), "{'value': None}"), invoice("4", at(4), "{'value': 40}")],
        "billtransactions": [transaction("1", at(4), "12"), transaction("9", at(4), "92")],
    },
    {
        "invoiceExtractedData": [invoice("2", at(7), "{'value': 20}"), invoice("2", at(7), "{'value': None}")],
        "receiptExtractedData": [receipt("9", at(7), "{'value': 91}")],
    },
]

FULL = [
    ("1", "S1", "Ann", 10.0, "Old"),
    ("2", "S1", "Ann", 20.0, "Old"),
    ("3", "S3", "Ann", None, None),
    ("4", "S1", "Ann", 40.0, "Old"),
    ("9", "S1", "Ann", 90.0, "Old"),
]
SHOWN = ("billId", "storeId", "name", "billAmount", "storeName")


def run_batches(spark, folder, load):
    for number, batch in enumerate(BATCHES):
        add_raw(spark, folder, str(number), **batch)
        etl.load_all_bronze(spark, f"{folder}/raw", folder, at(10 + number))
        load(spark, folder, at(12 + number, 30))
    return silver_bills_table(spark, folder)


def test_upserts_equal_one_full_load(spark, folder):
    found = run_batches(spark, folder, etl.upsert_silver_bills)
    assert found.drop("createdMonth").columns == SILVER["all_bills"].names
    assert rows(found, *SHOWN) == FULL
    bronze = {name: etl.bronze_table(spark, folder, name) for name in COLLECTIONS}
    full = etl.silver_bills(bronze, at(20))
    lineage = ("billId", "in_id", "rec_id", "bt_id", "load_br", "load_in", "load_rec", "load_bt")
    assert rows(full.where("storeId is not null"), *lineage, *SHOWN) == rows(found, *lineage, *SHOWN)


def test_repeated_upsert_changes_nothing(spark, folder):
    before = rows(run_batches(spark, folder, etl.upsert_silver_bills), *SHOWN, "load_time")
    for hour in (14, 22):  # an hour before the last run has nothing to load either
        assert not etl.upsert_silver_bills(spark, folder, at(hour))
    assert rows(silver_bills_table(spark, folder), *SHOWN, "load_time") == before


def test_incremental_appends_join_new_rows_only(spark, folder):
    found = run_batches(spark, folder, etl.append_silver_bills)
    assert rows(found, *SHOWN) == [
        ("1", "S1", "Ann", 10.0, "Old"),  # first load, bill 3 has no store yet
        ("1", "S2", "Bob", 12.0, None),  # a copy in a later load stays
        ("2", "S1", "Ann", 21.0, "Old"),
        ("3", "S3", "Ann", None, None),
        ("4", "S1", "Ann", 42.0, "Old"),
        ("9", "S1", "Ann", 92.0, "Old"),  # its invoice came with an earlier load
    ]
    # Extraction watermarks move with matched rows, that of the requests with all.
    assert read_watermark(spark, folder, "silver", "billRequest") == at(11)
    assert read_watermark(spark, folder, "silver", "invoiceExtractedData") == at(10)
    assert read_watermark(spark, folder, "silver", "billtransactions") == at(11)


def test_silver_items_by_environment(spark, folder):
    schema = BRONZE["items-bronze"]
    for base in (f"{folder}/prod", f"{folder}/dev"):
        lines = [
            ("1", at(1), "tea", "5", "S1", at(1)),
            ("1", at(1), "tea", "6", "S1", at(2)),
            ("1", at(1), None, "7", "S1", at(1)),
            ("1", at(1), None, "7", "S1", at(1)),
        ]
        spark.createDataFrame(lines, schema).write.parquet(f"{base}/bronze/items-bronze/data/p1")
        assert etl.load_silver_items(spark, base, at(3)) == 2
        assert etl.load_silver_items(spark, base, at(4)) == 0
        later = [("1", at(1), "tea", "9", "S1", at(5)), ("2", at(2), "jam", "1", "S1", at(3))]
        spark.createDataFrame(later, schema).write.parquet(f"{base}/bronze/items-bronze/data/p2")
        assert etl.load_silver_items(spark, base, at(6)) == 2
        assert rows(silver_items_table(spark, base), "billId", "itemName", "itemPrice", "load_time") == [
            ("1", "tea", "6", at(3)), ("1", "tea", "9", at(6)), ("1", None, "7", at(3)), ("2", "jam", "1", at(6)),
        ]
        assert read_watermark(spark, base, "silver", "all_items") == at(5)


def test_item_load_moves_lines_once(spark, folder, monkeypatch):
    """One shuffle serves the dedupe and the layout by month; no month is scattered over files."""
    written = []
    commit = versions.commit
    monkeypatch.setattr("billweave.sinks.parquet.commit", lambda df, *a, **k: (written.append((df, k["hint"])), commit(df, *a, **k))[1])
    n = F.col("id")
    lines = spark.range(40_000).select(
        (n % 5_000).cast("string").alias("billId"),
        (F.lit(at(1)).cast("timestamp_ntz") + F.make_dt_interval(hours=n % 5_000)).alias("createdAt"),
        F.concat(F.lit("item "), (n % 10_000).cast("string")).alias("itemName"),
        F.lpad(n.cast("string"), 5, "0").alias("itemPrice"), F.lit("S1").alias("storeId"), F.lit(at(2)).cast("timestamp_ntz").alias("load_time"),
    )
    lines.select(*BRONZE["items-bronze"].names).repartition(8).write.parquet(f"{folder}/bronze/items-bronze/data/p1")
    assert etl.load_silver_items(spark, folder, at(3)) == 10_000
    ((df, hint),) = written
    assert not hint and len(re.findall(r"(?m)^\(\d+\) Exchange$", plan_of(df))) == 1
    found = silver_items_table(spark, folder)
    assert found.count() == 10_000 and found.where("itemPrice < '30000'").count() == 0
    files = [m.split("/")[0] for m in spark.read.parquet(f"{folder}/silver/all_items/data").inputFiles() for m in m.split("createdMonth=")[1:]]
    assert len(set(files)) == 7 and len(files) <= 7 + 4


def test_items_of_drifted_files(spark, folder):
    path, schema = f"{folder}/bronze/items-bronze/data", BRONZE["items-bronze"]
    first = spark.createDataFrame([("1", at(1), "tea", "5", "S1", at(1))], schema)
    first.drop("storeId").write.mode("append").parquet(path)
    second = spark.createDataFrame([("2", at(1), "jam", "6.5", "S1", at(1))], schema)
    second.withColumn("itemPrice", F.col("itemPrice").cast("double")).withColumn("unit", F.lit("jar")).write.mode("append").parquet(path)
    assert etl.load_silver_items(spark, folder, at(3)) == 2
    found = spark.read.option("mergeSchema", "true").parquet(f"{folder}/silver/all_items/data")
    assert rows(found, "billId", "itemPrice", "storeId", "unit") == [("1", "5", None, None), ("2", "6.5", "S1", "jar")]


def test_union_by_file(spark, folder):
    spark.range(1).select(F.col("id").cast("int").alias("a")).write.mode("append").parquet(folder)
    spark.range(1, 2).select("id", F.lit("abc").alias("amount"), F.lit(1).alias("b")).write.mode("append").parquet(folder)
    spark.range(2, 3).select(F.col("id").alias("a"), F.lit(2.5).alias("amount"), F.lit("x").alias("b")).write.mode("append").parquet(folder)
    declared = StructType().add("a", "long").add("amount", "double").add("never", "string")
    found = read_union_by_name(spark, [folder], declared)
    assert dict(found.dtypes) == {"a": "bigint", "amount": "double", "never": "string", "id": "bigint", "b": "string"}
    assert rows(found, "a", "amount", "b", "id") == [(0, None, None, None), (2, 2.5, "x", None), (None, None, "1", 1)]


def test_unreadable_text_in_drifted_transactions(spark, folder):
    path = f"{folder}/raw/billtransactions/data/a"
    raw_rows(spark, "billtransactions", transaction("1", at(1), "abc")).write.mode("append").parquet(path)
    numbers = raw_rows(spark, "billtransactions", transaction("2", at(1), "7"))
    numbers.withColumn("billAmount", F.col("billAmount").cast("double")).write.mode("append").parquet(path)
    assert etl.load_bronze(spark, f"{folder}/raw", folder, "billtransactions", at(3)) == at(1)
    assert rows(etl.bronze_table(spark, folder, "billtransactions"), "billId", "billAmount") == [("1", None), ("2", 7.0)]


def test_copies_of_a_loaded_request_are_not_new(spark, folder):
    for number in (0, 1):
        add_raw(spark, folder, str(number), billRequest=[request("1", at(1 + 3 * number))], storeDetails=[])
        etl.load_all_bronze(spark, f"{folder}/raw", folder, at(10 + number))
    assert etl.append_silver_bills(spark, folder, at(12)) == 1
    assert etl.append_silver_bills(spark, folder, at(13)) == 0
    assert read_watermark(spark, folder, "silver", "billRequest") == at(11)
    assert rows(silver_bills_table(spark, folder), "billId") == [("1",)]


def test_upsert_after_append(spark, folder):
    loads = iter((etl.append_silver_bills, etl.upsert_silver_bills, etl.upsert_silver_bills))
    assert rows(run_batches(spark, folder, lambda *a: next(loads)(*a)), *SHOWN) == FULL


def test_a_late_store_reaches_its_bills(spark, folder):
    for number, batch in enumerate([{"billRequest": [request("1", at(1))]}, {"storeDetails": [store("S1", "One", at(4))]}, {"storeDetails": [store("S1", "Two", at(7))]}]):
        add_raw(spark, folder, str(number), **batch)
        etl.load_all_bronze(spark, f"{folder}/raw", folder, at(10 + number))
        assert etl.upsert_silver_bills(spark, folder, at(12 + number, 30))
        assert rows(silver_bills_table(spark, folder), "billId", "storeName") == [("1", [None, "One", "Two"][number])]
    assert not etl.upsert_silver_bills(spark, folder, at(20))


def files_of(spark, path):
    return data_files(spark, path).count()


def test_loads_do_not_pile_up_files(spark, folder, monkeypatch):
    """One bill a load, all in one store month: new files are read once and the tables stay small."""
    monkeypatch.setattr(versions.merge_commits, "__defaults__", (3,))
    listed = []
    for number in range(7):
        add_raw(spark, folder, str(number), billRequest=[request(str(number), at(1, number))])
        new = unread_files(spark, f"{folder}/raw/billRequest/data", folder, "bronze", "billRequest")
        assert len(new) == 1
        etl.load_bronze(spark, f"{folder}/raw", folder, "billRequest", at(10, number))
        assert not unread_files(spark, f"{folder}/raw/billRequest/data", folder, "bronze", "billRequest")
        if number % 3 == 0:
            etl.append_silver_bills(spark, folder, at(12, number))
        version = versions.current(spark, f"{folder}/bronze/billRequest/data")
        listed.append(len(version.commits))
    etl.append_silver_bills(spark, folder, at(13))
    # Levels of three: at most two commits each.
    assert max(listed) <= 6
    assert rows(etl.bronze_table(spark, folder, "billRequest"), "billId") == sorted((str(n),) for n in range(7))
    assert silver_bills_table(spark, folder).count() == 7
    assert files_of(spark, f"{folder}/silver/all_bills/data") <= 4
    assert files_of(spark, f"{folder}/bronze/billRequest/watermark") <= KEPT_ROWS
    assert len(versions.current(spark, ledger_path(folder, "bronze", "billRequest")).commits) <= 6


def write_file(spark, path, name, df, modified):
    """One parquet file of a given name and time of change."""
    draft = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    df.coalesce(1).write.mode("append").parquet(draft)
    os.makedirs(path, exist_ok=True)
    found = next(f for f in os.listdir(draft) if f.endswith(".parquet"))
    shutil.copyfile(f"{draft}/{found}", f"{path}/{name}")
    os.utime(f"{path}/{name}", (modified, modified))


def test_files_committed_late_are_read_once(spark, folder):
    """A file older than the last one read, with newer rows, and a copy that keeps its time."""
    path, now = f"{folder}/raw/billRequest/data/a", 1_700_000_000
    write_file(spark, path, "1.parquet", raw_rows(spark, "billRequest", request("1", at(10))), now + 1200)
    assert etl.load_bronze(spark, f"{folder}/raw", folder, "billRequest", at(12)) == at(10)
    write_file(spark, path, "2.parquet", raw_rows(spark, "billRequest", request("2", at(11))), now + 300)
    assert etl.load_bronze(spark, f"{folder}/raw", folder, "billRequest", at(13)) == at(11)
    write_file(spark, path, "3.parquet", raw_rows(spark, "billRequest", request("3", at(11, 30))), now + 300)
    assert etl.load_bronze(spark, f"{folder}/raw", folder, "billRequest", at(14)) == at(11, 30)
    assert etl.load_bronze(spark, f"{folder}/raw", folder, "billRequest", at(15)) is None
    assert rows(etl.bronze_table(spark, folder, "billRequest"), "billId") == [("1",), ("2",), ("3",)]
    # A file that is written anew, longer than before, is a new file.
    more = raw_rows(spark, "billRequest", request("3", at(11, 30)), request("4", at(16)), request("5", at(16)))
    write_file(spark, path, "3.parquet", more, now + 300)
    assert etl.load_bronze(spark, f"{folder}/raw", folder, "billRequest", at(17)) == at(16)
    assert etl.bronze_table(spark, folder, "billRequest").count() == 5
    assert read_ledger(spark, folder, "bronze", "billRequest").count() == 4


def test_item_files_committed_late(spark, folder):
    path, schema = f"{folder}/bronze/items-bronze/data/a", BRONZE["items-bronze"]
    line = lambda bill, load: spark.createDataFrame([(bill, at(1), "tea", "5", "S1", load)], schema)
    write_file(spark, path, "1.parquet", line("1", at(10)), 1_700_001_200)
    assert etl.load_silver_items(spark, folder, at(12)) == 1
    write_file(spark, path, "2.parquet", line("2", at(11)), 1_700_000_300)
    assert etl.load_silver_items(spark, folder, at(13)) == 1
    assert etl.load_silver_items(spark, folder, at(14)) == 0
    assert rows(silver_items_table(spark, folder), "billId") == [("1",), ("2",)]


def test_a_load_that_died_before_its_ledger_is_repeated(spark, folder, monkeypatch):
    add_raw(spark, folder, "1", billRequest=[request("1", at(1)), request("2", at(1))])

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(etl, "record_files", dies)
        with pytest.raises(RuntimeError):
            etl.load_bronze(spark, f"{folder}/raw", folder, "billRequest", at(3))
    add_raw(spark, folder, "2", billRequest=[request("3", at(2))])
    assert etl.load_bronze(spark, f"{folder}/raw", folder, "billRequest", at(3)) == at(2)
    assert rows(etl.bronze_table(spark, folder, "billRequest"), "billId") == [("1",), ("2",), ("3",)]


def test_an_upsert_reads_the_buckets_of_its_bills(spark, folder):
    """Folder filters on all four inputs; the files read do not grow with the loads before."""
    read = []
    for number in range(4):
        bills = [f"{number}-{i}" for i in range(40 if number == 0 else 1)]
        add_raw(
            spark, folder, str(number),
            billRequest=[request(b, at(1, number)) for b in bills],
            invoiceExtractedData=[invoice(b, at(1, number), "{'value': 1}") for b in bills],
            receiptExtractedData=[receipt(b, at(1, number), "{'value': 2}") for b in bills],
            billtransactions=[transaction(b, at(1, number), "3") for b in bills],
        )
        etl.load_all_bronze(spark, f"{folder}/raw", folder, at(10, number))
        etl.upsert_silver_bills(spark, folder, at(12, number))
        ids = spark.createDataFrame([(b,) for b in bills], "billId string")
        inputs = etl.bronze_of_bills(spark, folder, ids)
        files = [f for name in etl.BILL_INPUTS for f in inputs[name].select("_metadata.file_path").distinct().collect()]
        read.append(len(files))
        if number:
            for name in etl.BILL_INPUTS:
                assert re.search(r"PartitionFilters: .*billBucket#", plan_of(inputs[name])), plan_of(inputs[name])
    assert max(read[1:]) <= 4 * 4 < read[0]
    assert silver_bills_table(spark, folder).count() == 43


def drifted_files(spark, path, count):
    """Many files, of three kinds of footer in turn."""
    kinds = [
        spark.range(1).select(F.col("id").cast("int").alias("a")),
        spark.range(1).select("id", F.lit("abc").alias("amount")),
        spark.range(1).select(F.col("id").alias("a"), F.lit(2.5).alias("amount")),
    ]
    os.makedirs(path)
    for k, df in enumerate(kinds):
        draft = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        df.coalesce(1).write.mode("append").parquet(draft)
        found = next(f for f in os.listdir(draft) if f.endswith(".parquet"))
        for i in range(k, count, 3):
            shutil.copyfile(f"{draft}/{found}", f"{path}/{i}.parquet")


def test_schemas_of_many_files_come_from_one_job(spark, folder):
    drifted_files(spark, f"{folder}/many", 600)
    paths = [row["path"] for row in data_files(spark, f"{folder}/many").collect()]
    spark.sparkContext.setJobGroup("footers", "footers")
    try:
        groups = parquet._by_schema(spark, paths)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("footers")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert sorted(len(files) for _, files in groups) == [200, 200, 200]
    assert len(jobs) <= 8  # the grouping, and one look per schema
    declared = StructType().add("a", "long").add("amount", "double")
    found = read_union_by_name(spark, [f"{folder}/many"], declared)
    assert found.count() == 600 and found.where("amount = 2.5").count() == 200


def test_schemas_of_files_only_spark_can_open(spark, folder, monkeypatch):
    monkeypatch.setattr(parquet, "_OPENED_IN_TASKS", ())
    drifted_files(spark, f"{folder}/some", 9)
    declared = StructType().add("a", "long").add("amount", "double")
    assert rows(read_union_by_name(spark, [f"{folder}/some"], declared), "a", "amount", "id") == sorted(
        [(0, None, None)] * 3 + [(None, None, 0)] * 3 + [(0, 2.5, None)] * 3, key=str
    )
