"""Readers of parquet collections, and of the versioned tables the package writes."""

from __future__ import annotations

import functools
import hashlib
import io
import re
from collections.abc import Iterable, Iterator, Mapping

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType, StructField, StructType

from billweave.functions.calendar import MONTH_FOLDER
from billweave.versions import COMMIT, current, read_version

#: Stores whose files a task opens by itself, reading their ends only. In others Spark
#: brings the task each file whole.
_OPENED_IN_TASKS = ("file:", "hdfs:")
_FOOTERS_A_TASK = 100


def _subtree(spark: SparkSession) -> DataFrameReader:
    return spark.read.option("recursiveFileLookup", "true")


def read_collection(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All parquet files at or below ``path``, under a declared schema; of a table those that count."""
    version = current(spark, path)
    if version is not None:
        return read_version(spark, path, version, {}, schema).select(*schema.names)
    return _subtree(spark).schema(schema).parquet(path)


def data_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, millis) of the parquet files at or below ``path``; none is opened."""
    reader = _subtree(spark).format("binaryFile").option("pathGlobFilter", "*.parquet")
    return reader.load(path).select("path", "length", F.unix_millis("modificationTime").alias("millis"))


def _footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Files, by path or with their content, to a hash of the schema in their footers."""
    for batch in batches:
        found, columns = [], batch.to_pydict()
        for i, path in enumerate(columns["path"]):
            if "content" in columns:
                schema = pyarrow.parquet.ParquetFile(io.BytesIO(columns["content"][i])).schema
            else:
                store, inside = pyarrow.fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path))
                with store.open_input_file(inside) as file:
                    schema = pyarrow.parquet.ParquetFile(file).schema
            # The first line names the library that wrote the file, and where it lies.
            found.append(hashlib.md5("\n".join(str(schema).split("\n")[1:]).encode()).hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], ["path", "schema"])


def _by_schema(spark: SparkSession, files: list[str]) -> list[tuple[StructType, list[str]]]:
    """Files grouped by the schema in their footers; one Spark schema per group.

    The footers are read in one job, however many files there are; a hash of each comes back.
    """
    if all(f.startswith(_OPENED_IN_TASKS) for f in files):
        rows = spark.createDataFrame([(f,) for f in files], "path string")
        source = rows.repartition(-(-len(files) // _FOOTERS_A_TASK))
    else:
        source = spark.read.format("binaryFile").load(files).select("path", "content")
    groups: dict[str, list[str]] = {}
    for row in sorted(source.mapInArrow(_footers, "path string, schema string").collect()):
        groups.setdefault(row["schema"], []).append(row["path"])
    return [(spark.read.parquet(group[0]).schema, group) for group in groups.values()]


def read_union_by_name(
    spark: SparkSession, paths: Iterable[str], declared: StructType | None = None
) -> DataFrame:
    """Files of one collection whose columns drifted over time, from one file to the next.

    ``paths`` are files or folders. Columns are matched by name and missing ones are NULL.
    Declared columns get their declared type, with NULL where a value has none in it;
    they are there even if no file has them. Of other columns numeric types widen, and
    types that do not go together become text. Files with equal footers are read
    together, so the plan grows with the number of distinct schemas only.
    """
    paths = list(paths)
    folders = [p for p in paths if not p.endswith(".parquet") or _is_folder(spark, p)]
    files = [p for p in paths if p not in set(folders)]
    files += [row["path"] for p in folders for row in data_files(spark, p).select("path").collect()]
    if not files:
        if declared is None:
            raise ValueError("no files to read")
        return spark.createDataFrame([], declared)
    groups = _by_schema(spark, files)
    kinds: dict[str, set] = {}
    for schema, _ in groups:
        for field in schema.fields:
            kinds.setdefault(field.name, set()).add(field.dataType)
    wanted = {field.name: field.dataType for field in declared.fields} if declared else {}

    def column(field: StructField) -> Column:
        name, found = F.col(f"`{field.name}`"), kinds[field.name]
        if field.name in wanted:
            same = field.dataType == wanted[field.name]
            return (name if same else name.cast("string").try_cast(wanted[field.name])).alias(field.name)
        if len(found) > 1 and not all(isinstance(kind, NumericType) for kind in found):
            return name.cast("string").alias(field.name)
        return name

    parts = [
        spark.read.schema(schema).parquet(*group).select(*[column(field) for field in schema.fields])
        for schema, group in groups
    ]
    if declared is not None:
        parts.insert(0, spark.createDataFrame([], declared))
    return functools.reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), parts)


def _is_folder(spark: SparkSession, path: str) -> bool:
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.getFileStatus(root).isDirectory()


def read_partitioned(
    spark: SparkSession,
    path: str,
    partition_types: Mapping[str, str],
    schema: StructType | None = None,
) -> DataFrame:
    """A dataset laid out in ``column=value`` folders, the newest version of it if it has any.

    The partition columns get the given types instead of guessed ones, so ``0012``
    stays a string. Filters on them select folders.
    """
    version = current(spark, path)
    if version is not None:
        rows = read_version(spark, path, version, partition_types, schema)
        return rows.drop(COMMIT) if schema is None else rows.select(*[F.col(f"`{c}`") for c in schema.names])
    data = spark.read.parquet(path).schema if schema is None else schema
    fields = StructType([f for f in data.fields if f.name not in partition_types])
    for name, kind in partition_types.items():
        fields = fields.add(name, kind)
    read = spark.read.schema(fields).parquet(path)
    return read.select(*[F.col(f"`{c}`") for c in data.names])


def read_by_month(
    spark: SparkSession, path: str, partition_types: Mapping[str, str], schema: StructType
) -> DataFrame:
    """``read_partitioned``, with the month folder as a column where the layout has one."""
    version = current(spark, path)
    columns = spark.read.parquet(path).columns if version is None else version.columns
    if MONTH_FOLDER not in columns:
        return read_partitioned(spark, path, partition_types, schema)
    fields = StructType([*schema.fields, StructField(MONTH_FOLDER, StringType())])
    return read_partitioned(spark, path, {**partition_types, MONTH_FOLDER: "string"}, fields)
