"""Intermediate tables several steps read, kept in the cluster's shared folder."""

from __future__ import annotations

import contextlib
import contextvars
import functools
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

_area: contextvars.ContextVar[str | None] = contextvars.ContextVar("staging_area", default=None)


@functools.cache
def _local_folder(application_id: str) -> str:
    return tempfile.mkdtemp(prefix=f"billweave-{application_id}-")


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    A local session without the setting gets a folder of its own. A cluster session
    without it is an error: a folder of one machine is lost with that machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = _local_folder(spark.sparkContext.applicationId)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{_area.get() or shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextlib.contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Remove at the end what is staged inside the block."""
    folder = new_folder(spark, "staging")
    token = _area.set(folder)
    try:
        yield
    finally:
        _area.reset(token)
        remove_folder(spark, folder)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back.

    Readers then share one computation, lost executors cost no recomputation, columns
    are still pruned, and the planner knows the size when it picks a join.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
