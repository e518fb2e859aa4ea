"""Publishing metrics from the silver tables of a base folder."""

from __future__ import annotations

import contextvars
import logging
import threading
from collections.abc import Iterable
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billweave.functions.calendar import AsOf
from billweave.plans.registry import BILLS, ITEMS, METRICS, ROLLUPS, SEGMENTS, Metric
from billweave.schemas import SILVER
from billweave.sinks.parquet import publish
from billweave.sources.parquet import read_by_month, read_partitioned
from billweave.staging import staged, staging

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Outcome:
    name: str
    path: str
    error: Exception | None = None


def silver_bills_table(spark: SparkSession, base: str) -> DataFrame:
    path = f"{base}/silver/all_bills/data"
    return read_by_month(spark, path, {"storeId": "string"}, SILVER["all_bills"])


def silver_items_table(spark: SparkSession, base: str) -> DataFrame:
    return read_by_month(spark, f"{base}/silver/all_items/data", {}, SILVER["all_items"])


def gold_path(base: str, name: str) -> str:
    return f"{base}/gold/{name}"


def gold_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    return read_partitioned(spark, gold_path(base, name), {METRICS[name].partition_by: "string"})


class _Tables:
    """The inputs of one run, each opened or computed when a metric first needs it."""

    def __init__(self, spark: SparkSession, base: str, chosen: dict[str, Metric], as_of: AsOf):
        self._spark, self._base, self._as_of = spark, base, as_of
        uses = [m.rollup for m in chosen.values()]
        self._shared = {r for r in ROLLUPS if uses.count(r) > 1}
        self._opened: dict[str, Future[DataFrame]] = {}
        self._lock = threading.Lock()

    def _open(self, name: str) -> DataFrame:
        if name == BILLS:
            return silver_bills_table(self._spark, self._base)
        if name == ITEMS:
            return silver_items_table(self._spark, self._base)
        if name == SEGMENTS:
            metric = METRICS["rfm_segments"]
            return staged(metric(*self.inputs(metric), as_of=self._as_of), "segments")
        make, inputs, dated = ROLLUPS[name]
        day = {"as_of": self._as_of} if dated else {}
        return staged(make(*[self[table] for table in inputs], **day), f"rollup-{name}")

    def __getitem__(self, name: str) -> DataFrame:
        """The table; who asks first makes it, others wait for this table only.

        If it cannot be made, all who ask get the error.
        """
        with self._lock:
            mine = name not in self._opened
            future = self._opened.setdefault(name, Future())
        if mine:
            try:
                future.set_result(self._open(name))
            except Exception as error:  # noqa: BLE001 - raised again by result()
                future.set_exception(error)
        return future.result()

    def inputs(self, metric: Metric) -> list[DataFrame]:
        if metric.rollup in self._shared:
            return [self[metric.rollup]]
        return [self[name] for name in metric.inputs]


def run_metrics(
    spark: SparkSession,
    base: str,
    names: Iterable[str] | None = None,
    as_of: AsOf = None,
    parallel: int = 4,
) -> list[Outcome]:
    """Publish the named metrics, or all of them, under ``base/gold``.

    Metrics that read the same rollup share one computation of it, and up to
    ``parallel`` of them are published at a time, so short stages do not leave the
    cluster idle. Segments are computed once in a run, for its day, and are published and
    counted from there; if they fail, what needs them fails, too. A metric that fails is
    reported with its error and the others go on. Without ``as_of`` the day on which the
    run starts holds for all of it.
    """
    if as_of is None:
        as_of = spark.range(1).select(F.current_date()).first()[0]
    chosen = METRICS if names is None else {name: METRICS[name] for name in names}
    tables = _Tables(spark, base, chosen, as_of)

    def run(name: str) -> Outcome:
        metric, path = chosen[name], gold_path(base, name)
        try:
            result = tables[SEGMENTS] if name == "rfm_segments" else metric(*tables.inputs(metric), as_of=as_of)
            publish(result, path, metric.partition_by, metric.order, spread=not metric.by_store)
        except Exception as error:  # noqa: BLE001 - reported, the other metrics go on
            log.exception("metric %s failed", name)
            return Outcome(name, path, error)
        return Outcome(name, path)

    with staging(spark), ThreadPoolExecutor(parallel) as pool:
        # Each thread gets the staging area through a copy of the context.
        running = [pool.submit(contextvars.copy_context().run, run, name) for name in chosen]
        return [outcome.result() for outcome in running]
