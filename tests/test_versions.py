"""Versioned tables: a version counts as a whole or not at all."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from billweave import versions
from billweave.sinks.parquet import append_batch, publish, replace_partitions
from billweave.sources.parquet import read_collection, read_partitioned
from tests.test_etl import rows

KEY = ["storeId", "month"]


def table(spark, *values):
    return spark.createDataFrame(list(values), "storeId string, month string, v int")


def read(spark, path):
    found = read_partitioned(spark, path, dict.fromkeys(KEY, "string"))
    return rows(found, "storeId", "month", "v")


FIRST = [("a b/c", "05", 1), (None, "05", 2), ("S=1", "06", 3), ("é%", "06", 4)]


def test_a_commit_that_stops_between_partitions_changes_nothing(spark, folder, monkeypatch):
    """Some partitions of the new version are written, the pointer is not."""
    path = f"{folder}/t"
    replace_partitions(table(spark, *FIRST), path, KEY)
    before = read(spark, path)

    @F.udf("int")
    def breaks(v):
        if v == 12:
            raise ValueError("lost")
        return v

    fresh = table(spark, ("a b/c", "05", 11), ("S=1", "06", 12)).repartitionByRange(2, "v")
    with pytest.raises(Exception, match="lost"):
        replace_partitions(fresh.withColumn("v", breaks("v")), path, KEY)
    assert read(spark, path) == before

    def stopped(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as patched:
        patched.setattr(versions._Files, "put", stopped)
        with pytest.raises(RuntimeError):
            replace_partitions(fresh, path, KEY)
    assert read(spark, path) == before
    replace_partitions(fresh, path, KEY)
    assert read(spark, path) == rows(table(spark, ("a b/c", "05", 11), (None, "05", 2), ("S=1", "06", 12), ("é%", "06", 4)), *KEY, "v")


def test_partitions_are_replaced_and_old_ones_go(spark, folder):
    path = f"{folder}/t"
    expected = {}
    for n in range(6):
        values = [(s, m, 10 * n + v) for s, m, v in FIRST[n % 3 :]]
        expected |= {(s, m): v for s, m, v in values}
        replace_partitions(table(spark, *values), path, KEY)
        assert read(spark, path) == rows(table(spark, *[(*k, v) for k, v in expected.items()]), *KEY, "v")
    # Of each partition the newest is there, and what the last commit has retired.
    files = [f for f in spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path).select("path").collect()]
    assert len(files) <= 2 * len(expected)
    assert len(versions.current(spark, path).commits) <= 3


def test_a_reader_may_finish_while_the_next_commit_is_made(spark, folder):
    path = f"{folder}/t"
    replace_partitions(table(spark, *FIRST), path, KEY)
    reader = read_partitioned(spark, path, dict.fromkeys(KEY, "string"))
    replace_partitions(table(spark, *[(s, m, v + 1) for s, m, v in FIRST]), path, KEY)
    assert rows(reader, *KEY, "v") == rows(table(spark, *FIRST), *KEY, "v")


def test_only_folders_that_count_are_read(spark, folder):
    path = f"{folder}/t"
    replace_partitions(table(spark, *FIRST), path, KEY)
    replace_partitions(table(spark, ("S=1", "06", 5)), path, KEY)
    found = read_partitioned(spark, path, dict.fromkeys(KEY, "string")).where("month = '06'")
    assert found.select("_metadata.file_path").distinct().count() == 2
    assert "PartitionFilters" in found._jdf.queryExecution().executedPlan().toString()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "commit" in plan.split("PartitionFilters", 1)[1].split("]", 1)[0]


def test_labels_replace_their_rows(spark, folder):
    path, at = f"{folder}/t", dt.datetime(2024, 5, 1, 3)
    schema = "v int, createdAt timestamp_ntz"
    row = lambda v: spark.createDataFrame([(v, at)], schema)
    for by_month in (False, True):
        where = f"{path}-{by_month}"
        append_batch(row(1), where, at, by_month)
        append_batch(row(2), where, at, by_month, name="other")
        append_batch(row(3), where, at, by_month)
        assert rows(read_collection(spark, where, row(1).schema), "v") == [(2,), (3,)]


def test_merged_commits_keep_all_rows(spark, folder):
    path = f"{folder}/t"
    for n in range(14):
        versions.commit(table(spark, (f"S{n % 2}", "05", n)), path, KEY, label=str(n))
        versions.merge_commits(spark, path, table(spark, *FIRST).schema, {}, most=3)
        assert len(versions.current(spark, path).commits) <= 6
    assert sorted(r[2] for r in read(spark, path)) == list(range(14))


def test_two_writers_cannot_make_one_version(spark, folder, monkeypatch):
    path = f"{folder}/t"
    replace_partitions(table(spark, *FIRST), path, KEY)
    old = versions.current(spark, path)
    replace_partitions(table(spark, ("S=1", "06", 5)), path, KEY)
    monkeypatch.setattr(versions, "current", lambda *_: old)
    with pytest.raises(RuntimeError):
        replace_partitions(table(spark, ("S=1", "06", 6)), path, KEY)
    monkeypatch.undo()
    assert ("S=1", "06", 5) in read(spark, path)


def test_tables_that_cannot_be_versioned_are_refused(spark, folder):
    table(spark, *FIRST).write.parquet(f"{folder}/plain")
    with pytest.raises(ValueError):
        publish(table(spark, *FIRST), f"{folder}/plain")
    publish(table(spark, *FIRST), f"{folder}/t")
    with pytest.raises(ValueError):
        replace_partitions(table(spark, *FIRST), f"{folder}/t", KEY)
