"""Loading raw collections to bronze and bronze to silver under a base folder.

A load reads the source files that its ledger does not name, whenever they were written.
Data is written first, then the ledger and the watermark. A batch is labelled with the
minute of its run: repeating a run that died, with its run time, replaces its batch. Repeated
later, it loads the same rows again; silver keeps one of them. New rows in the minute of
a completed load are refused, as they would replace its rows; they load a minute later.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from billweave.functions.calendar import MONTH_FOLDER, month_folder
from billweave.operators.bronze import BRONZE_EXTRACTORS
from billweave.operators.incremental import incremental_load, is_up_to_date, moment, run_minute, stamped
from billweave.operators.silver import (
    BILL_INPUTS,
    EXTRACTIONS,
    affected_bills,
    bills_to_write,
    current_stores,
    refreshed_bills,
    silver_bills,
    silver_items,
)
from billweave.schemas import BRONZE, RAW, SILVER
from billweave.sinks.parquet import (
    BATCH_FORMAT,
    BILL_BUCKET,
    BILL_BUCKETS,
    LOAD_DAY,
    append_batch,
    append_by_bill,
    bill_bucket,
    replace_partitions,
)
from billweave.sources.ledger import File, record_files, unread_files
from billweave.sources.parquet import read_by_month, read_union_by_name
from billweave.sources.watermark import advance_watermark, last_run, read_watermark
from billweave.staging import staged, staging
from billweave.versions import COMMIT, current, merge_commits, read_version

# Collections without bills are not laid out by day and bill.
_NOT_BY_BILL = {"storeDetails"}
_BY_BILL_TYPES = {LOAD_DAY: "string", BILL_BUCKET: "integer"}


def data_path(base: str, layer: str, collection: str) -> str:
    return f"{base}/{layer}/{collection}/data"


def rows_of(spark: SparkSession, files: list[File], declared: StructType) -> DataFrame:
    """The rows of files that may differ in their columns."""
    return read_union_by_name(spark, [file.path for file in files], declared)


def _commit_rows(spark: SparkSession, path: str, schema: StructType, commit: str) -> DataFrame:
    """The rows one commit has written."""
    rows = read_version(spark, path, current(spark, path), {}, schema)
    return rows.where(F.col(COMMIT) == commit).select(*schema.names)


def bronze_table(
    spark: SparkSession, base: str, collection: str,
    since: dt.datetime | None = None, buckets: list[int] | None = None,
) -> DataFrame:
    """Bronze rows; with ``since`` those loaded later, with ``buckets`` those of bills in them.

    Both select folders, so other files are not read. Empty before the first load.
    """
    path, schema = data_path(base, "bronze", collection), BRONZE[collection]
    version = current(spark, path)
    if version is None:
        return spark.createDataFrame([], schema)
    by_bill = collection not in _NOT_BY_BILL
    rows = read_version(spark, path, version, _BY_BILL_TYPES if by_bill else {}, schema)
    if since is not None:
        if by_bill:
            rows = rows.where(F.col(LOAD_DAY) >= since.date().isoformat())
        rows = incremental_load(rows, "trans_time", since)
    if buckets is not None and by_bill and len(buckets) < BILL_BUCKETS:
        rows = rows.where(F.col(BILL_BUCKET).isin(buckets))
    return rows.select(*schema.names)


def _may_run(
    spark: SparkSession, base: str, layer: str, collection: str, run_time: dt.datetime, new: DataFrame
) -> bool:
    """Whether a load of ``new`` may use this run time; a used one is an error if there are rows."""
    last = last_run(spark, base, layer, collection)
    if last is None or run_time > last:
        return True
    if new.isEmpty():
        return False
    raise ValueError(f"{layer} {collection}: the load of {last} is complete, {run_time} is not after it")


def load_bronze(
    spark: SparkSession,
    raw_base: str,
    base: str,
    collection: str,
    run_time: dt.datetime | None = None,
    skip_if_up_to_date: bool = False,
) -> dt.datetime | None:
    """Bring the new rows of one raw collection to bronze; returns the new watermark.

    New are rows of files that have not been read, with a load time after the watermark.
    """
    run_time = run_minute(run_time)
    files = unread_files(spark, f"{raw_base}/{collection}/data", base, "bronze", collection)
    if not files:
        return None
    raw = rows_of(spark, files, RAW[collection])
    watermark = read_watermark(spark, base, "bronze", collection)
    if skip_if_up_to_date and is_up_to_date(raw, watermark):
        return None
    new = incremental_load(raw, "load_time", watermark)
    if not _may_run(spark, base, "bronze", collection, run_time, new):
        return None
    return write_bronze(new, base, collection, run_time, files)


def write_bronze(
    new: DataFrame, base: str, collection: str, run_time: dt.datetime, files: list[File], name: str | None = None
) -> dt.datetime | None:
    """Write new raw rows to bronze under a stamp, record their files and move the watermark.

    A rerun replaces the rows; it is known by its run time, or by ``name``.
    """
    spark, label = new.sparkSession, name or run_time.strftime(BATCH_FORMAT)
    batch = stamped(BRONZE_EXTRACTORS[collection](new), "trans_time", run_time)
    path, schema = data_path(base, "bronze", collection), BRONZE[collection]
    by_bill = collection not in _NOT_BY_BILL
    commit = append_by_bill(batch, path, label) if by_bill else append_batch(batch, path, run_time, name=name)
    written = _commit_rows(spark, path, schema, commit)
    record_files(spark, files, base, "bronze", collection, label)
    newest = advance_watermark(written, base, "bronze", collection, "load_time", run_time)
    merge_commits(spark, path, schema, _BY_BILL_TYPES if by_bill else {})
    return newest


def load_all_bronze(
    spark: SparkSession, raw_base: str, base: str, run_time: dt.datetime | None = None
) -> dict[str, dt.datetime | None]:
    """Load every raw collection, at the same time; they do not depend on each other."""
    run_time = run_minute(run_time)

    def load(collection: str) -> dt.datetime | None:
        return load_bronze(spark, raw_base, base, collection, run_time)

    with ThreadPoolExecutor(len(BRONZE_EXTRACTORS)) as pool:
        return dict(zip(BRONZE_EXTRACTORS, pool.map(load, BRONZE_EXTRACTORS)))


def _bronze_since(
    spark: SparkSession, base: str, watermarks: dict[str, dt.datetime | None]
) -> dict[str, DataFrame]:
    """What is new since the watermarks, and all stores."""
    new = {name: bronze_table(spark, base, name, watermarks[name]) for name in BILL_INPUTS}
    return {**new, "storeDetails": bronze_table(spark, base, "storeDetails")}


def _bill_watermarks(spark: SparkSession, base: str) -> dict[str, dt.datetime | None]:
    return {name: read_watermark(spark, base, "silver", name) for name in BILL_INPUTS}


def append_silver_bills(
    spark: SparkSession, base: str, run_time: dt.datetime | None = None, skip_if_up_to_date: bool = False
) -> int:
    """Add the bills that are new since the watermarks; returns how many there were.

    The watermark of the requests moves with all of them, also with copies and with those
    without a store, which are not written; those of the extractions move with the ones
    that found a bill. An extraction that comes in a later load than its bill is not
    attached, and copies are removed inside one load only; ``upsert_silver_bills`` does
    better. Both keep one layout, so either may follow the other. The months a batch falls
    in are rewritten with it, so files do not add up, and a rerun replaces its batch.
    """
    run_time = run_minute(run_time)
    watermarks = _bill_watermarks(spark, base)
    if skip_if_up_to_date and is_up_to_date(bronze_table(spark, base, "billRequest"), watermarks["billRequest"]):
        return 0
    bronze = _bronze_since(spark, base, watermarks)
    requests = bronze["billRequest"]
    if not _may_run(spark, base, "silver", "billRequest", run_time, requests):
        return 0
    with staging(spark):
        batch = staged(silver_bills(bronze, run_time, watermarks), "silver-bills")
        fresh = bills_to_write(batch).withColumn(MONTH_FOLDER, month_folder())
        other_batch = lambda old: old.where(~F.col("load_time").eqNullSafe(moment(run_time)))
        _write_into_months(spark, base, fresh, other_batch)
        advance_watermark(requests, base, "silver", "billRequest", "trans_time", run_time)
        for name, (id_name, load_name) in EXTRACTIONS.items():
            advance_watermark(batch, base, "silver", name, load_name, run_time, known=id_name)
        return batch.count()


def upsert_silver_bills(spark: SparkSession, base: str, run_time: dt.datetime | None = None) -> bool:
    """Bring silver bills to what one full load of all bronze rows would give.

    Bills that any new bronze row belongs to are assembled anew and replace their old
    rows. Bronze is kept by buckets of bills, and only the buckets of these bills are read.
    The table is kept by store and month of the bill, and only the months that
    change are rewritten; as a bill keeps its first request, it never leaves its month.
    A store whose name is new or has changed reaches its old bills, too.
    All months change in one commit. Returns whether anything changed.
    """
    run_time = run_minute(run_time)
    watermarks = _bill_watermarks(spark, base)
    watermarks["storeDetails"] = read_watermark(spark, base, "silver", "storeDetails")
    new = _bronze_since(spark, base, watermarks)
    with staging(spark):
        ids = staged(_bills_to_refresh(spark, base, new, watermarks), "affected-bills")
        if not _may_run(spark, base, "silver", "billRequest", run_time, ids):
            return False
        changed = _write_merged(spark, base, ids, watermarks, run_time)
    new["storeDetails"] = bronze_table(spark, base, "storeDetails", watermarks["storeDetails"])
    for name in (*BILL_INPUTS, "storeDetails"):
        advance_watermark(new[name], base, "silver", name, "trans_time", run_time)
    return changed


def bronze_of_bills(spark: SparkSession, base: str, ids: DataFrame) -> dict[str, DataFrame]:
    """The bronze inputs, cut to the folders that may hold rows of the bills in ``ids``.

    At most one number per bucket reaches the driver.
    """
    touched = ids.select(bill_bucket(F.col("billId")).alias("bucket")).distinct()
    buckets = sorted(row["bucket"] for row in touched.collect())
    inputs = {name: bronze_table(spark, base, name, buckets=buckets) for name in BILL_INPUTS}
    return {**inputs, "storeDetails": bronze_table(spark, base, "storeDetails")}


def _silver_bills_kept(spark: SparkSession, base: str) -> DataFrame | None:
    """Silver bills with their month folder, or ``None`` before the first load."""
    try:
        path = data_path(base, "silver", "all_bills")
        return read_by_month(spark, path, {"storeId": "string"}, SILVER["all_bills"])
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _bills_to_refresh(
    spark: SparkSession, base: str, bronze: dict[str, DataFrame], watermarks: dict[str, dt.datetime | None]
) -> DataFrame:
    """Bills with new bronze rows, and old bills of stores whose name is new or has changed."""
    ids = affected_bills(bronze, watermarks)
    old = _silver_bills_kept(spark, base)
    if old is None:
        return ids
    loaded = incremental_load(bronze["storeDetails"], "trans_time", watermarks["storeDetails"])
    names = current_stores(bronze["storeDetails"]).join(loaded.select("storeId").distinct(), "storeId", "left_semi")
    names = staged(names, "loaded-stores")
    if names.isEmpty():
        return ids
    renamed = (
        old.select("billId", "storeId", "storeName")
        .join(names.withColumnRenamed("storeName", "newName"), "storeId")
        .where(~F.col("storeName").eqNullSafe(F.col("newName")))
    )
    return ids.union(renamed.select("billId")).distinct()


def _write_merged(
    spark: SparkSession,
    base: str,
    ids: DataFrame,
    watermarks: dict[str, dt.datetime | None],
    run_time: dt.datetime,
) -> bool:
    if all(mark is None for mark in watermarks.values()):
        fresh = silver_bills(_bronze_since(spark, base, watermarks), run_time)
    else:
        fresh = refreshed_bills(bronze_of_bills(spark, base, ids), ids, run_time)
    fresh = staged(bills_to_write(fresh).withColumn(MONTH_FOLDER, month_folder()), "fresh-bills")
    if fresh.isEmpty():
        return False
    replaced = fresh.select("billId")
    _write_into_months(spark, base, fresh, lambda old: old.join(replaced, "billId", "left_anti"))
    return True


def _write_into_months(
    spark: SparkSession, base: str, fresh: DataFrame, kept: Callable[[DataFrame], DataFrame]
) -> None:
    """Rewrite the store months of ``fresh`` with its rows and what is kept of the old ones.

    The months' range selects folders at once; the join with the touched store months,
    which have a known size, lets the planner select the others while it runs.
    """
    key, old = ["storeId", MONTH_FOLDER], _silver_bills_kept(spark, base)
    if old is not None:
        touched = staged(fresh.select(*key).distinct(), "touched-months")
        first, last = touched.agg(F.min(MONTH_FOLDER), F.max(MONTH_FOLDER)).first()
        if first is None:
            return
        months = F.col(MONTH_FOLDER).between(first, last)
        inside = old.where(months).join(touched.where(months), key, "left_semi")
        fresh = kept(inside).unionByName(fresh)
    replace_partitions(fresh, data_path(base, "silver", "all_bills"), key)


def load_silver_items(
    spark: SparkSession, base: str, run_time: dt.datetime | None = None, skip_if_up_to_date: bool = False
) -> int:
    """Add the item lines that are new since the watermark: the newest load time seen.

    A watermark at the time of the run would lose lines that arrive later with an earlier
    load time. Columns beyond the declared ones are kept, files may differ in theirs. Call
    it once per environment, each with its own base folder. Returns the row count.
    """
    run_time = run_minute(run_time)
    files = unread_files(spark, data_path(base, "bronze", "items-bronze"), base, "silver", "all_items")
    if not files:
        return 0
    source = rows_of(spark, files, BRONZE["items-bronze"])
    watermark = read_watermark(spark, base, "silver", "all_items")
    if skip_if_up_to_date and is_up_to_date(source, watermark):
        return 0
    new = incremental_load(source, "load_time", watermark)
    if not _may_run(spark, base, "silver", "all_items", run_time, new):
        return 0
    path, schema = data_path(base, "silver", "all_items"), SILVER["all_items"]
    commit = append_batch(silver_items(new, run_time, by_time=True), path, run_time, by_month=True, spread=False)
    rows = _commit_rows(spark, path, schema, commit).count()
    record_files(spark, files, base, "silver", "all_items", run_time.strftime(BATCH_FORMAT))
    if rows:
        advance_watermark(new, base, "silver", "all_items", "load_time", run_time)
    merge_commits(spark, path, _all_columns(spark, path), {})
    return rows


def _all_columns(spark: SparkSession, path: str) -> StructType:
    """The columns of all commits: loads keep columns that are not declared."""
    return spark.read.option("mergeSchema", "true").parquet(path).drop(COMMIT).schema
