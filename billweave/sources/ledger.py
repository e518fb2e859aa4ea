"""Which source files a load has read.

A row per file: its path, length and time of change. A file is new if no load has read it
as it is now, whenever it was written and whenever it came: files that are committed late,
or copied with the times they had, are read, and each is read once. The ledger is written after
the rows of its files and before the watermark.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from billweave.schemas import LEDGER
from billweave.sources.parquet import data_files
from billweave.versions import commit, current, merge_commits, read_version

class File(NamedTuple):
    path: str
    length: int
    millis: int


def ledger_path(base: str, layer: str, collection: str) -> str:
    return f"{base}/{layer}/{collection}/ledger"


def read_ledger(spark: SparkSession, base: str, layer: str, collection: str) -> DataFrame | None:
    """(path, length, millis) of all files read so far, or ``None`` before the first."""
    path = ledger_path(base, layer, collection)
    version = current(spark, path)
    return None if version is None else read_version(spark, path, version, {}, LEDGER).select(*File._fields)


def unread(files: DataFrame, base: str, layer: str, collection: str) -> list[File]:
    """Those of ``files`` that no load of the collection has read as they are, by path."""
    known = read_ledger(files.sparkSession, base, layer, collection)
    new = files if known is None else files.join(known, list(File._fields), "left_anti")
    return sorted(File(*row) for row in new.select(*File._fields).collect())


def unread_files(spark: SparkSession, source: str, base: str, layer: str, collection: str) -> list[File]:
    """The source's files that are new to the collection. Only they come to the driver."""
    return unread(data_files(spark, source), base, layer, collection)


def record_files(spark: SparkSession, files: list[File], base: str, layer: str, collection: str, label: str) -> None:
    """Add files to the ledger; the same label again replaces its rows."""
    path = ledger_path(base, layer, collection)
    commit(spark.createDataFrame(files, LEDGER).coalesce(1), path, [], label)
    merge_commits(spark, path, LEDGER, {})
