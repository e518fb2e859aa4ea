"""Times the engine and prints one JSON line.

Metrics run over silver tables, which are prepared once from the driver's tables and not
timed; load steps and streams run over those tables directly. Results go to the noop
sink, so all rows are computed. Three metrics of recent months also run over the month
layout of the loads. ``run_all_metrics`` publishes every metric as parquet
by store, with the shared rollups.

BENCH_SF_DIR names the tables, BENCH_CPUS the cores, BENCH_RUNS the timed runs of each
query after one warm-up (their median counts) and BENCH_QUERIES, if set, the queries to
run, separated by commas.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billweave.functions.calendar import MONTH_FOLDER, month_folder
from billweave.operators.segments import rfm_segments
from billweave.plans.publishing import run_metrics, silver_bills_table, silver_items_table
from billweave.plans.registry import BILLS, ITEMS, METRICS, SEGMENTS
from billweave.schemas import SILVER
from billweave.session import build_session
from billweave.sinks.parquet import append_batch, replace_partitions
from verification import fixtures
from verification.queries import ALSO_ON_EVENTS, ON_EVENTS, queries

BY_MONTH = "by month"
RECENT = ("active_customers_30", "product_sales_this_month", "customer_item_purchase_frequency_last3_month")

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
CHOSEN = [name for name in os.environ.get("BENCH_QUERIES", "").split(",") if name]


def prepare(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """Silver bills and items, bills made from events, and the segments of the bills."""
    bills = fixtures.bills(spark, SF_DIR)
    for field in SILVER["all_bills"].fields:
        if field.name not in bills.columns:
            bills = bills.withColumn(field.name, F.lit(None).cast(field.dataType))
    written = {
        BILLS: (bills, "silver/all_bills/data"),
        ITEMS: (fixtures.items(spark, SF_DIR), "silver/all_items/data"),
        "event bills": (fixtures.bills_from_events(spark, SF_DIR), "event_bills"),
        SEGMENTS: (rfm_segments(bills, fixtures.AS_OF), "segments"),
    }
    tables = {}
    for name, (df, path) in written.items():
        df.repartition(int(CPUS)).write.parquet(f"{base}/{path}")
        tables[name] = spark.read.schema(df.schema).parquet(f"{base}/{path}")
    # The same tables as the loads lay them out, for the metrics that read recent months only.
    by_month = bills.where("storeId IS NOT NULL").withColumn(MONTH_FOLDER, month_folder())
    replace_partitions(by_month, f"{base}/months/silver/all_bills/data", ["storeId", MONTH_FOLDER])
    append_batch(tables[ITEMS], f"{base}/months/silver/all_items/data", fixtures.RUN_TIME, by_month=True)
    tables[BY_MONTH] = {
        BILLS: silver_bills_table(spark, f"{base}/months"), ITEMS: silver_items_table(spark, f"{base}/months")
    }
    return tables


def timed_queries(tables: dict[str, DataFrame], base: str) -> dict[str, Callable[[SparkSession], object]]:
    def to_noop(df: DataFrame) -> None:
        df.write.format("noop").mode("overwrite").save()

    def metric(name: str, on_events: bool):
        as_of = fixtures.EVENTS_AS_OF if on_events else fixtures.AS_OF
        chosen = {**tables, BILLS: tables["event bills"]} if on_events else tables
        return lambda spark: to_noop(METRICS[name](*[chosen[i] for i in METRICS[name].inputs], as_of=as_of))

    def metric_by_month(name: str):
        chosen = tables[BY_MONTH]
        return lambda spark: to_noop(METRICS[name](*[chosen[i] for i in METRICS[name].inputs], as_of=fixtures.AS_OF))

    found = {name: metric(name, name in ON_EVENTS) for name in METRICS}
    found |= {f"{name}_events": metric(name, True) for name in sorted(ALSO_ON_EVENTS)}
    steps = {name: query for name, query in queries().items() if name not in found}
    found |= {name: lambda spark, query=query: to_noop(query(spark, SF_DIR)) for name, query in steps.items()}

    def publish_all(spark: SparkSession) -> None:
        failed = [o for o in run_metrics(spark, base, as_of=fixtures.AS_OF) if o.error]
        if failed:
            raise failed[0].error

    found |= {f"{name}_by_month": metric_by_month(name) for name in RECENT}
    return found | {"run_all_metrics": publish_all}


def main() -> None:
    base = tempfile.mkdtemp(prefix="billweave-bench-")
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": f"{base}/shared",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def seconds(run: Callable[[SparkSession], object]) -> float:
        start = time.perf_counter()
        run(spark)
        return time.perf_counter() - start

    times = {}
    for name, run in timed_queries(prepare(spark, base), base).items():
        if CHOSEN and name not in CHOSEN:
            continue
        seconds(run)
        times[name] = round(statistics.median(seconds(run) for _ in range(RUNS)), 4)
    line = {
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
