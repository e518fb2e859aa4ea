"""Hot keys: results stay whole and the work is split."""

import datetime as dt
import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from billweave.operators import customers, dedupe, products, purchases, silver
from billweave.operators.segments import rfm_segments
from billweave.schemas import BRONZE
from billweave.sinks.parquet import publish
from billweave.sources.parquet import read_partitioned

A = dt.date(2024, 3, 31)
ROWS = 60_000


@contextmanager
def settings(spark, **values):
    """Small sizes, so that the tables of a test count as large."""
    before = {key: spark.conf.get(key) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "16",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16KB",
    # The default of Spark: joins are split only where that costs no further shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "false",
}


@pytest.fixture(scope="module")
def bills(spark, tmp_path_factory):
    """A third of the rows in one store, of one customer, and under one bill id."""
    n = F.col("id")
    third = lambda seed: F.pmod(F.xxhash64(n, F.lit(seed)), F.lit(3)) == 0
    number = F.pmod(F.xxhash64(n, F.lit(9)), F.lit(20_000)).cast("string")
    df = spark.range(ROWS).select(
        F.when(third(1), "hot").otherwise(n.cast("string")).alias("billId"),
        F.when(third(2), "S0").otherwise(F.concat(F.lit("S"), (n % 50).cast("string"))).alias("storeId"),
        F.when(third(3), "9999999999").otherwise(F.concat(F.lit("9"), F.lpad(number, 9, "0"))).alias("mobileNumber"),
        F.concat(F.lit("n"), (n % 7).cast("string")).alias("name"),
        (F.pmod(F.xxhash64(n, F.lit(5)), F.lit(100_000)) / 100).alias("billAmount"),
        F.timestamp_seconds(F.lit(1711800000) - n * 60).cast("timestamp_ntz").alias("createdAt"),
    )
    path = str(tmp_path_factory.mktemp("bills"))
    df.repartition(8).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def items(spark, bills, tmp_path_factory):
    """Two lines of each bill, so that the hot bill has a third of them."""
    line = F.explode(F.array(F.lit(0), F.lit(1)))
    df = bills.select("billId", "storeId", "createdAt", line.alias("line")).select(
        "billId",
        "storeId",
        "createdAt",
        F.concat(F.lit("item "), F.pmod(F.xxhash64("createdAt", "line"), F.lit(40)).cast("string")).alias("itemName"),
        F.lit("1.5").alias("itemPrice"),
    )
    path = str(tmp_path_factory.mktemp("items"))
    df.repartition(8).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    counted = df.groupBy().agg(F.count(F.lit(1)))
    counted.collect()
    return counted._jdf.queryExecution().executedPlan().toString()


def test_hot_bill_is_split_in_the_purchase_join(spark, bills, items):
    frequency = purchases.customer_item_purchase_frequency(bills, items)
    with settings(spark, **SMALL):
        assert "skew=true" in final_plan(frequency)
        total = frequency.agg(F.sum("times_purchased")).first()[0]
    of_bills = bills.select("billId", "storeId", "mobileNumber", "name").distinct().groupBy("billId").count()
    of_items = items.select("billId", "itemName").distinct().groupBy("billId").agg(F.count(F.lit(1)).alias("items"))
    assert total == of_bills.join(of_items, "billId").agg(F.sum(F.col("count") * F.col("items"))).first()[0]


def test_hot_store_is_written_by_several_tasks(spark, bills, folder):
    with settings(spark, **SMALL):
        publish(bills, folder + "/out")
    found = read_partitioned(spark, folder + "/out", {"storeId": "string"})
    files = dict(found.groupBy("storeId").agg(F.count_distinct("_metadata.file_path")).collect())
    assert files["S0"] > 3 and sum(files.values()) < 50 * 4
    assert found.count() == ROWS


def test_copies_of_a_hot_bill_are_gone_before_the_shuffle(spark, bills):
    schema = BRONZE["billRequest"]
    requests = bills.select(
        *[F.col(f.name) if f.name in bills.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    )
    nothing = {
        name: spark.createDataFrame([], BRONZE[name])
        for name in ("invoiceExtractedData", "receiptExtractedData", "billtransactions", "storeDetails")
    }
    found = silver.silver_bills({"billRequest": requests, **nothing}, dt.datetime(2024, 4, 1))
    assert found.count() == bills.select("billId").distinct().count()


def test_copies_of_a_hot_line_are_gone_before_lines_lie_by_time(spark, bills, monkeypatch):
    """A third of the lines are one line again and again, another sixth lack their time."""
    n = F.col("billAmount")
    lines = bills.select(
        "billId",
        F.when(F.col("billId") == "hot", F.lit(A).cast("timestamp_ntz")).when(n >= 500, F.col("createdAt")).alias("createdAt"),
        F.when(F.col("billId") != "hot", F.col("name")).alias("itemName"),
        n.cast("string").alias("itemPrice"), "storeId", F.lit(A).cast("timestamp_ntz").alias("load_time"),
    )
    lines = lines.union(lines.where("billId <> 'hot'"))
    expected = dedupe.distinct_items(lines)
    key = ("createdAt", "billId", "itemName")
    assert dedupe._crowded(lines, key) == []
    monkeypatch.setattr(dedupe, "_MORE", 100)
    crowded = dedupe._crowded(lines, key)
    assert crowded == [r[0] for r in lines.where("billId = 'hot'").select(dedupe._key_hash(key)).distinct().collect()]
    with settings(spark, **SMALL):
        found = dedupe.distinct_items(lines, by_time=True)
        # Crowded keys are cut in the tasks that read them, then in one per key, then moved.
        plan = final_plan(found)
        others = found.where(~dedupe._key_hash(key).isin(crowded))
        spans = others.groupBy(F.spark_partition_id()).agg(F.min("createdAt"), F.max("createdAt")).collect()
    assert re.search(r"WindowGroupLimit [^\n]*Partial\n.*Scan parquet", plan.split("rangepartitioning")[-1], re.S)
    assert found.count() == expected.count() and found.exceptAll(expected).isEmpty()
    spans = sorted((a, b) for _, a, b in spans if a is not None and a != b)
    assert len(spans) > 3 and all(b <= c for (_, b), (c, _) in zip(spans, spans[1:], strict=False))


def test_segments_of_a_hot_store(bills):
    one = bills.withColumn("storeId", F.lit("S0"))
    segments = rfm_segments(one, A)
    shares = dict(segments.groupBy("m_score").count().collect())
    total = sum(shares.values())
    assert total == customers.top_spenders(one).count()
    for score, share in ((5, 0.1), (4, 0.2), (3, 0.3), (2, 0.2), (1, 0.2)):
        assert abs(shares[score] / total - share) < 0.01


def test_repeat_customers_of_a_hot_number(bills):
    repeat = customers.repeat_customers_name_and_number(bills)
    assert repeat.agg(F.sum("visit_count")).first()[0] + customers.top_spenders(bills).select(
        "storeId", "mobileNumber"
    ).distinct().count() - repeat.count() == ROWS


def test_pairs_of_a_hot_bill_are_spread(spark):
    """One basket of 5,000 items: twelve million pairs, about as many in each task."""
    n = 5000
    wide = spark.range(n).select(
        F.lit("b").alias("billId"),
        F.lit("S0").alias("storeId"),
        F.lit("2024-03-01 00:00:00").cast("timestamp_ntz").alias("createdAt"),
        F.format_string("i%05d", "id").alias("itemName"),
    )
    starts = F.sequence(F.lit(1), F.size("item_combination"), F.lit(100))
    parts = F.transform(starts, lambda start: F.slice("item_combination", start, F.lit(100)))
    blocks = products.baskets(wide).select(*products._BASKET, parts.alias("parts")).select(
        *products._BASKET, F.size("parts").alias("last"), F.posexplode("parts").alias("number", "part")
    )
    inside, between = products._pairs_inside(blocks), products._pairs_between(blocks)
    sizes = [row["count"] for row in between.groupBy(F.spark_partition_id()).count().collect()]
    assert inside.count() + sum(sizes) == n * (n - 1) // 2
    assert len(sizes) > 1 and max(sizes) < 1.25 * sum(sizes) / len(sizes)
