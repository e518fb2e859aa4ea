"""The incremental loads as streams: the checkpoint takes the place of the watermark."""

from __future__ import annotations

import datetime as dt
import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from billweave.operators.dedupe import ITEM_KEY
from billweave.plans.etl import rows_of, write_bronze
from billweave.schemas import RAW
from billweave.sources.ledger import unread
from billweave.sources.watermark import last_run


def _as_instant(naive: Column) -> Column:
    """A naive time read as UTC whatever the session zone; streams need zoned event times."""
    return F.from_utc_timestamp(naive.cast("timestamp"), F.current_timezone())


def _as_naive(instant: Column) -> Column:
    return F.to_utc_timestamp(instant, F.current_timezone()).cast("timestamp_ntz")


def stream_collection(
    spark: SparkSession, path: str, schema: StructType, files: str = "*.parquet", files_per_batch: int = 1000
) -> DataFrame:
    return (
        spark.readStream.schema(schema)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", files)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(path)
    )


def append_available(rows: DataFrame, path: str, checkpoint: str, *partition_by: str) -> StreamingQuery:
    """Append everything that is there now to a parquet dataset, then stop."""
    writer = rows.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.trigger(availableNow=True).start(path)


def stream_bronze(
    spark: SparkSession, raw_base: str, base: str, collection: str, checkpoint: str, files_per_batch: int = 1000
) -> StreamingQuery:
    """New raw files of a collection to bronze, into the table the batch load writes.

    The stream is one of files; each batch reads its files as the batch load does, so
    they may differ in their columns, and writes with its sinks. Files that are in the
    ledger, from batch loads or another stream, are left out; those of the batch are
    added to it, and the watermark moves with each batch, so batch loads go on from there.
    A batch is labelled with the stream and its number, so a batch that is repeated
    replaces itself, and stamped with the time it is written, which is after that of all
    loads before, so silver loads find it however old its files are.
    """
    arrivals = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(f"{raw_base}/{collection}/data")
        .select("path", "length", F.unix_millis("modificationTime").alias("millis"))
    )
    stream = f"stream-{zlib.crc32(checkpoint.encode()):08x}"

    def load(batch: DataFrame, number: int) -> None:
        files = unread(batch, base, "bronze", collection)
        if not files:
            return
        before = last_run(spark, base, "bronze", collection)
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        stamp = now if before is None else max(now, before + dt.timedelta(microseconds=1))
        rows = rows_of(spark, files, RAW[collection])
        write_bronze(rows, base, collection, stamp, files, name=f"{stream}-{number:09d}")

    return (
        arrivals.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def first_items(items: DataFrame, delay: str = "1 day", time: str = "createdAt") -> DataFrame:
    """Item lines without the copies that follow within ``delay`` of the first.

    Lines more than ``delay`` behind the newest one are late, and left out.
    """
    return (
        items.withColumn(time, _as_instant(F.col(time)))
        .withWatermark(time, delay)
        .dropDuplicatesWithinWatermark(list(ITEM_KEY))
        .withColumn(time, _as_naive(F.col(time)))
    )


def daily_sales(bills: DataFrame, delay: str = "1 day", time: str = "createdAt") -> DataFrame:
    """Sales by store and day, given out once ``delay`` after the day's end has passed."""
    return (
        bills.withColumn(time, _as_instant(F.col(time)))
        .withWatermark(time, delay)
        .groupBy(F.window(time, "1 day"), "storeId")
        .agg(F.sum("billAmount").alias("total_sales"))
        .select("storeId", F.to_date(_as_naive(F.col("window.start"))).alias("date"), "total_sales")
    )


def held_sales(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Sales of the days that the stream of ``daily_sales`` has not given out yet.

    Read from the state the last batch has left. Such a day may still grow; the stream
    gives it out, once and for good, when its delay has passed.
    """
    state = spark.read.format("statestore").load(checkpoint)
    return state.select(
        F.col("key.storeId").alias("storeId"),
        F.to_date(_as_naive(F.col("key.window.start"))).alias("date"),
        F.col("value.sum").alias("total_sales"),
    )


def sales_so_far(spark: SparkSession, path: str, checkpoint: str) -> DataFrame:
    """All days: those the stream has written to ``path``, and those it holds (``final`` false).

    Take it between runs of the stream. A day stands in one of the two.
    """
    given = spark.read.schema("storeId string, date date, total_sales double").parquet(path)
    held = held_sales(spark, checkpoint)
    return given.withColumn("final", F.lit(True)).union(held.withColumn("final", F.lit(False)))


def late_rows(query: StreamingQuery) -> int:
    """How many rows a stream has left out, in its latest batches, as they came too late."""
    return sum(
        int(operator.numRowsDroppedByWatermark)
        for progress in query.recentProgress
        for operator in progress.stateOperators
    )
