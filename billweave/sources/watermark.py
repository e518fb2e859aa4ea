"""Watermarks: how far a collection has been loaded.

A watermark is a small parquet dataset that gains one row per completed load; its
newest value counts. Nothing is overwritten, so a run that dies leaves the last
watermark readable. Rows beyond the newest few are removed after a new one is written.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billweave.operators.incremental import max_timestamp, moment
from billweave.schemas import WATERMARK

# So many of the newest rows are kept.
KEPT_ROWS = 8

# Fixed value: the text form of a watermark.
WATERMARK_FORMAT = "%Y-%m-%d %H:%M:%S"


def watermark_path(base: str, layer: str, collection: str) -> str:
    return f"{base}/{layer}/{collection}/watermark"


def parse_watermark(text: str) -> dt.datetime:
    """A watermark kept as text elsewhere, for taking it over with ``write_watermark``."""
    return dt.datetime.strptime(text.strip(), WATERMARK_FORMAT)


def _newest(spark: SparkSession, base: str, layer: str, collection: str, column: str) -> dt.datetime | None:
    try:
        rows = spark.read.schema(WATERMARK).parquet(watermark_path(base, layer, collection))
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return max_timestamp(rows, column)


def read_watermark(spark: SparkSession, base: str, layer: str, collection: str) -> dt.datetime | None:
    """The watermark, or ``None`` before the first load."""
    return _newest(spark, base, layer, collection, "watermark")


def last_run(spark: SparkSession, base: str, layer: str, collection: str) -> dt.datetime | None:
    """The run time of the last completed load."""
    return _newest(spark, base, layer, collection, "run_time")


def write_watermark(
    spark: SparkSession,
    base: str,
    layer: str,
    collection: str,
    value: dt.datetime,
    run_time: dt.datetime,
) -> None:
    row = spark.range(1, numPartitions=1).select(
        F.lit(collection).alias("collection"),
        moment(value).alias("watermark"),
        moment(run_time).alias("run_time"),
    )
    path = watermark_path(base, layer, collection)
    row.write.mode("append").parquet(path)
    _remove_old(spark, path)


def _remove_old(spark: SparkSession, path: str) -> None:
    """Remove all but the newest files; each has one row, and later rows are never smaller."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [s for s in files.listStatus(root) if s.isFile() and s.getPath().getName().startswith("part-")]
    for status in sorted(found, key=lambda s: s.getModificationTime())[:-KEPT_ROWS]:
        files.delete(status.getPath(), False)


def advance_watermark(
    loaded: DataFrame,
    base: str,
    layer: str,
    collection: str,
    column: str,
    run_time: dt.datetime,
    known: str | None = None,
) -> dt.datetime | None:
    """Move the watermark to the newest ``column`` of what was loaded.

    Only rows where ``known`` is not NULL count; without any the watermark stays. Call
    it after the data is written: a run that dies in between loads its rows again.
    """
    newest = max_timestamp(loaded, column, known)
    if newest is not None:
        write_watermark(loaded.sparkSession, base, layer, collection, newest, run_time)
    return newest
