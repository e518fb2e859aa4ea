"""Watermark-driven loads."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: how near the newest row must be to the watermark to count as loaded.
UP_TO_DATE_SECONDS = 60


def run_minute(run_time: dt.datetime | None = None) -> dt.datetime:
    """The run's time stamp: UTC, cut to the minute, one constant for the whole run."""
    moment = run_time or dt.datetime.now(dt.timezone.utc)
    return moment.replace(second=0, microsecond=0, tzinfo=None)


def moment(value: dt.datetime, df: DataFrame | None = None, column: str | None = None) -> Column:
    """A naive time as a literal in the type of ``df[column]``."""
    kind = df.schema[column].dataType if df is not None else "timestamp_ntz"
    return F.lit(value.isoformat(sep=" ")).cast(kind)


def incremental_load(df: DataFrame, time_column: str, watermark: dt.datetime | None) -> DataFrame:
    """Rows strictly after the watermark; all rows where there is none yet."""
    if watermark is None:
        return df
    return df.where(F.col(time_column) > moment(watermark, df, time_column))


def stamped(df: DataFrame, column: str, run_time: dt.datetime) -> DataFrame:
    return df.withColumn(column, moment(run_time))


def max_timestamp(df: DataFrame, column: str = "createdAt", known: str | None = None) -> dt.datetime | None:
    """Newest time of a column, over the rows where ``known`` is not NULL if given."""
    value = F.col(column) if known is None else F.when(F.col(known).isNotNull(), F.col(column))
    return df.agg(F.max(value).alias("newest")).first()["newest"]


def is_up_to_date(
    df: DataFrame,
    watermark: dt.datetime | None,
    column: str = "createdAt",
    tolerance_seconds: int = UP_TO_DATE_SECONDS,
) -> bool:
    """Whether the newest row lies within the tolerance of the watermark.

    The loaders do not use it unless asked to: it compares creation times with a load
    watermark, so it can pass over rows that were created early and loaded late.
    """
    newest = max_timestamp(df, column) if watermark is not None else None
    return newest is not None and abs((newest - watermark).total_seconds()) < tolerance_seconds
