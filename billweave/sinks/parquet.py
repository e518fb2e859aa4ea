"""Writers of parquet datasets.

Each write is one commit of a versioned table (``billweave.versions``): readers see all of
it or nothing. Writes into partitions go through ``rebalance``: rows of one partition value
come together in a few files, small values share a task, and a value that holds much of the
data is split over several tasks. Rows that already lie together are written where they
are, without a shuffle.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billweave.functions.calendar import MONTH_FOLDER, month_folder
from billweave.versions import commit

# Fixed value: how a batch is named after the minute of its run.
BATCH_FORMAT = "%Y%m%d_%H%M"

# Partition columns of the bronze tables of bills: the day of the load, and one of so many
# buckets that a bill's id falls into.
LOAD_DAY, BILL_BUCKET = "loadDay", "billBucket"
BILL_BUCKETS = 16


def bill_bucket(bill: Column) -> Column:
    return F.pmod(F.xxhash64(bill), F.lit(BILL_BUCKETS)).cast("int")


def _replace_partitions(
    df: DataFrame, path: str, columns: Sequence[str], order: Sequence[Column] = (), spread: bool = True
) -> None:
    commit(df, path, columns, hint=columns if spread else (), order=order)


def publish(
    df: DataFrame,
    path: str,
    partition_by: str = "storeId",
    order: Sequence[Column] = (),
    spread: bool = True,
) -> None:
    """Replace the partitions that occur in ``df`` and leave the others.

    ``order`` sorts the rows inside each file; a dataset has no order of its own. Give
    ``spread=False`` for rows that were read by partition anyway.
    """
    _replace_partitions(df, path, [partition_by], order, spread)


def append_batch(
    df: DataFrame, path: str, run_time: dt.datetime, by_month: bool = False, name: str | None = None, spread: bool = True
) -> str:
    """Add a batch named after its minute; the same minute again replaces it. Returns the commit.

    With ``by_month`` the rows lie in the folders of the months of ``createdAt``. A ``name``
    takes the place of the minute. Give ``spread=False`` for rows in ranges of ``createdAt``.
    """
    label = name or run_time.strftime(BATCH_FORMAT)
    if by_month:
        hint = [MONTH_FOLDER] if spread else []
        return commit(df.withColumn(MONTH_FOLDER, month_folder()), path, [MONTH_FOLDER], label, hint=hint)
    return commit(df, path, [], label)


def append_stamped(df: DataFrame, path: str, stamp: str = "trans_time") -> None:
    """Add a batch as the partition of its run stamp, a constant; a rerun replaces it."""
    _replace_partitions(df, path, [stamp], spread=False)


def append_by_bill(df: DataFrame, path: str, label: str, stamp: str = "trans_time") -> str:
    """Add rows by the day of their stamp and the bucket of their bill; returns the commit.

    Reads of what is new select days, and lookups of bills select buckets. The same label
    again replaces its rows.
    """
    placed = df.withColumn(LOAD_DAY, F.col(stamp).cast("date").cast("string")).withColumn(
        BILL_BUCKET, bill_bucket(F.col("billId"))
    )
    return commit(placed, path, [LOAD_DAY, BILL_BUCKET], label, hint=[LOAD_DAY, BILL_BUCKET])


def replace_partitions(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """Replace exactly the partitions that occur in ``df``."""
    _replace_partitions(df, path, columns)
