"""What the planner makes of the metrics, and publishing them."""

import datetime as dt
import os
import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from billweave.operators import customers, products, purchases, sales
from billweave.operators.segments import cust_segment_count, rfm_segments
from billweave.plans.publishing import (
    gold_path,
    gold_table,
    run_metrics,
    silver_bills_table,
    silver_items_table,
)
from billweave.plans.registry import METRICS, ROLLUPS, SEGMENTS
from billweave.schemas import SILVER
from billweave.functions.calendar import MONTH_FOLDER, month_folder
from billweave.sinks.parquet import append_batch, replace_partitions
from billweave.staging import shared_folder, staged, staging
from verification import fixtures
from verification.check import differences, oracle_connection
from verification.oracle import oracle_sql
from verification.queries import queries

SF = "/root/testdata/sf0.001"
LAZY = [name for name, m in METRICS.items() if SEGMENTS not in m.inputs and name != "rfm_segments"]


def plan_of(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.fixture(scope="module")
def silver(spark, tmp_path_factory):
    """Silver tables on disk, as the metrics meet them."""
    base = str(tmp_path_factory.mktemp("silver"))
    bills = fixtures.bills(spark, SF)
    for field in SILVER["all_bills"].fields:
        if field.name not in bills.columns:
            bills = bills.withColumn(field.name, F.lit(None).cast(field.dataType))
    bills.write.partitionBy("storeId").parquet(f"{base}/silver/all_bills/data")
    fixtures.items(spark, SF).write.parquet(f"{base}/silver/all_items/data")
    return base


@pytest.fixture(scope="module")
def tables(spark, silver):
    return {"bills": silver_bills_table(spark, silver), "items": silver_items_table(spark, silver)}


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_joins_and_no_python(tables, name):
    metric = METRICS[name]
    plan = plan_of(metric(*[tables[i] for i in metric.inputs], as_of=fixtures.AS_OF))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ArrowEval", "MapInPandas"):
        assert node not in plan, node


def test_visit_windows_do_not_copy_rows(tables):
    assert "Expand" not in plan_of(customers.customer_visit_windows_dev(tables["bills"], fixtures.AS_OF))


def test_latest_rows_are_cut_before_the_shuffle(tables):
    plan = plan_of(customers.inactive_customers(tables["bills"], fixtures.AS_OF, 60, ("mobileNumber",)))
    assert plan.index("WindowGroupLimit") < plan.rindex("WindowGroupLimit")


def read_schema(plan):
    return {c for found in re.findall(r"ReadSchema: struct<(.*?)>", plan) for c in re.findall(r"(\w+):", found)}


@pytest.mark.parametrize(
    "make, columns",
    [
        (lambda t: sales.daily_sales_trend(t["bills"]), {"billAmount", "createdAt"}),
        (lambda t: sales.daily_bill_count(t["bills"]), {"billId", "createdAt"}),
        (lambda t: customers.top_spenders(t["bills"]), {"name", "mobileNumber", "billAmount"}),
        (lambda t: products.product_quantity_this_month(t["items"]), {"billId", "storeId", "createdAt", "itemName"}),
        (
            lambda t: purchases.customer_item_purchase_frequency(t["bills"], t["items"]),
            {"billId", "mobileNumber", "name", "itemName"},
        ),
    ],
)
def test_only_needed_columns_are_read(tables, make, columns):
    assert read_schema(plan_of(make(tables))) == columns


@pytest.mark.parametrize(
    "make",
    [
        lambda t: customers.active_customers(t["bills"], fixtures.AS_OF),
        lambda t: products.product_sales_this_month(t["items"], fixtures.AS_OF),
        lambda t: purchases.customer_item_purchase_frequency(t["bills"], t["items"], fixtures.AS_OF, 3),
    ],
)
def test_time_bounds_reach_the_scan(tables, make):
    assert re.search(r"PushedFilters: .*GreaterThanOrEqual\(createdAt", plan_of(make(tables)))


@pytest.fixture(scope="module")
def by_month(spark, tables, tmp_path_factory):
    """The same tables as the loads of this package lay them out, one row without a time."""
    base = str(tmp_path_factory.mktemp("months"))
    run_time = fixtures.RUN_TIME
    timeless = tables["items"].limit(1).withColumn("createdAt", F.lit(None).cast("timestamp_ntz"))
    bills = tables["bills"].where("storeId is not null").withColumn(MONTH_FOLDER, month_folder())
    replace_partitions(bills, f"{base}/silver/all_bills/data", ["storeId", MONTH_FOLDER])
    append_batch(tables["items"].union(timeless), f"{base}/silver/all_items/data", run_time, by_month=True)
    return {"bills": silver_bills_table(spark, base), "items": silver_items_table(spark, base)}


RECENT = [
    "active_customers_30",
    "product_quantity_this_month",
    "product_quantity_this_quarter",
    "product_sales_this_month",
    "product_sales_last_3_month",
    "customer_item_purchase_frequency_last3_month",
]


@pytest.mark.parametrize("name", RECENT)
def test_recent_metrics_read_only_their_month_folders(tables, by_month, name):
    metric = METRICS[name]

    def result(source):
        return metric(*[source[i] for i in metric.inputs], as_of=fixtures.AS_OF)

    assert re.search(r"PartitionFilters: \[.*createdMonth", plan_of(result(by_month)))
    known = {"bills": tables["bills"].where("storeId is not null"), "items": tables["items"]}
    rounded = [F.round(c, 6).alias(c) if kind == "double" else c for c, kind in result(known).dtypes]
    assert differences(result(known).select(*rounded).toPandas(), result(by_month).select(*rounded).toPandas()) == []


def test_latest_month_is_found_without_reading_items(by_month):
    plan = plan_of(products.product_quantity_this_quarter(by_month["items"]))
    assert "ReadSchema: struct<>" in plan


def test_month_folders_are_no_bill_column(by_month):
    assert customers.storewise_data(by_month["bills"]).columns == SILVER["all_bills"].names


def test_staging_removes_its_folders(spark):
    outside = staged(spark.range(3), "outside")
    with staging(spark):
        inside = staged(spark.range(3), "inside")
        files = ["/" + f.removeprefix("file:").lstrip("/") for f in inside.inputFiles()]
        assert inside.count() == 3 and all(map(os.path.exists, files))
    assert not any(map(os.path.exists, files))
    assert outside.count() == 3 and all(shared_folder(spark) in f for f in outside.inputFiles())


def test_store_filter_selects_folders(tables):
    plan = plan_of(sales.daily_sales_trend(tables["bills"]).where("storeId = 'S1'"))
    assert re.search(r"PartitionFilters: .*storeId.* = S1", plan)


@pytest.mark.parametrize("name", [n for n, m in METRICS.items() if m.rollup and n in LAZY])
def test_rollups_give_the_same_result(tables, name):
    metric = METRICS[name]
    make, inputs, dated = ROLLUPS[metric.rollup]
    rollup = make(*[tables[i] for i in inputs], **({"as_of": fixtures.AS_OF} if dated else {}))

    def result(*sources):
        df = metric(*sources, as_of=fixtures.AS_OF)
        rounded = [F.round(c, 6).alias(c) if kind == "double" else c for c, kind in df.dtypes]
        return df.select(*rounded).toPandas()

    assert differences(result(*[tables[i] for i in metric.inputs]), result(rollup)) == []


def test_run_publishes_all_metrics_and_reports_failures(spark, silver):
    outcomes = run_metrics(spark, silver, as_of=fixtures.AS_OF)
    assert [o.name for o in outcomes] == list(METRICS) and not [o for o in outcomes if o.error]
    daily = gold_table(spark, silver, "daily_sales_trend")
    windows = gold_table(spark, silver, "sales_windows")
    total = daily.where("storeId is not null").agg(F.sum("total_sales")).first()[0]
    assert abs(total - windows.agg(F.sum("sales_lifetime")).first()[0]) < 0.01
    again = run_metrics(spark, silver, ["churn_60day"], fixtures.AS_OF)
    assert again[0].path == gold_path(silver, "churn_60day") and again[0].error is None

    outcomes = run_metrics(spark, f"{silver}/absent", ["daily_bill_count", "storewise_data"], fixtures.AS_OF)
    assert all(o.error is not None for o in outcomes) and len(outcomes) == 2


def test_segments_fail_together(spark, silver, monkeypatch):
    names = ["rfm_segments", "cust_segment_count", "cust_segment_spend", "monthly_bills"]

    def broken(*_, **__):
        raise RuntimeError("no segments today")

    monkeypatch.setitem(METRICS, "rfm_segments", replace(METRICS["rfm_segments"], compute=broken))
    outcomes = {o.name: o.error for o in run_metrics(spark, silver, names, fixtures.AS_OF)}
    assert outcomes["monthly_bills"] is None and all(outcomes[n] is not None for n in names[:3])


def test_segment_counts_are_of_the_asked_day(spark, silver):
    day = dt.date(1999, 6, 30)
    (outcome,) = run_metrics(spark, silver, ["cust_segment_count"], day)
    assert outcome.error is None
    expected = cust_segment_count(rfm_segments(silver_bills_table(spark, silver), day))
    columns = ["storeId", "customer_segment", "count_of_customers"]
    found = gold_table(spark, silver, "cust_segment_count").select(*columns)
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.select(*columns).collect()))


def test_pair_counts_add_up(tables):
    pairs = products.product_pairs(tables["items"]).agg(F.sum("pair_count")).first()[0]
    sizes = products.baskets(tables["items"]).select(F.size("item_combination").alias("n"))
    assert pairs == sizes.agg(F.sum(F.expr("n * (n - 1) div 2"))).first()[0]


def test_active_and_inactive_split_the_customers(tables):
    bills, key = tables["bills"], ("mobileNumber",)
    active = customers.active_customers(bills, fixtures.AS_OF, 30, key).select("mobileNumber")
    inactive = customers.inactive_customers(bills, fixtures.AS_OF, 30, key).select("mobileNumber")
    known = bills.where("storeId is not null and length(mobileNumber) = 10").select("mobileNumber").distinct()
    assert active.intersect(inactive).isEmpty()
    assert active.union(inactive).exceptAll(known).isEmpty() and known.exceptAll(active.union(inactive)).isEmpty()


def test_segment_scores_and_counts(spark, tables):
    segments = rfm_segments(tables["bills"], fixtures.AS_OF)
    scores = segments.agg(*[f(c) for c in ("r_score", "f_score", "m_score") for f in (F.min, F.max)]).first()
    assert set(scores) <= {1, 2, 3, 4, 5}
    counted = cust_segment_count(segments).agg(F.sum("count_of_customers")).first()[0]
    assert counted >= segments.select("storeId", "mobileNumber").distinct().count()


def test_publishing_twice_gives_the_same_table(spark, silver):
    def published():
        (outcome,) = run_metrics(spark, silver, ["product_basket"], fixtures.AS_OF)
        assert outcome.error is None
        return gold_table(spark, silver, "product_basket")

    first = [tuple(map(str, row)) for row in published().collect()]
    assert sorted(first) == sorted(tuple(map(str, row)) for row in published().collect()) and first


def test_files_are_sorted_inside(spark, silver):
    run_metrics(spark, silver, ["top_spenders"], fixtures.AS_OF)
    rows = gold_table(spark, silver, "top_spenders").select("total_spend", "_metadata.file_path").collect()
    by_file = {}
    for spend, file in rows:
        by_file.setdefault(file, []).append(spend if spend is not None else float("-inf"))
    assert len(by_file) > 1 and all(values == sorted(values, reverse=True) for values in by_file.values())


def test_every_query_has_a_twin_or_is_a_stream():
    without = set(queries()) - set(oracle_sql())
    assert all(name.startswith("stream_") for name in without)
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_its_twin(spark, name):
    expected = oracle_connection(SF).execute(oracle_sql()[name]).df()
    found = differences(expected, queries()[name](spark, SF).toPandas())
    assert not [text for text in found if not text.startswith("note")]


@pytest.mark.parametrize("name", ["avg_week", "monthly_bills", "sales_trend_date_hour", "product_sales_this_month", "stream_daily_sales", "stream_first_items"])
def test_results_do_not_depend_on_the_session_zone(spark, name):
    expected = oracle_connection(SF).execute(oracle_sql()[name]).df()
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        found = differences(expected, queries()[name](spark, SF).toPandas())
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert not [text for text in found if not text.startswith("note")]
