"""Mixing sources to target weights by weighted fair queueing.

The documents of a source queue in a shuffled order, again and again up to three times.
A document's virtual finish time is the number of words its source has sent by then,
divided by the source's target. All queues are merged in the order of finish times, and
the merged queue is cut where the words reach the budget.

Running totals are taken in blocks of the order: sums per block, totals over the blocks,
then rows inside a block; no source and no queue is sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from billweave.llm.native import whole, word_count
from billweave.staging import staged

#: A document is taken so many times at most.
REPEATS = 3
BLOCK_ROWS = 4000
#: Blocks are added up in groups of so many before the groups are.
_GROUP = 1000


def _block_starts(sums: DataFrame, by: list[str], block: str, value: str) -> DataFrame:
    """``sums`` (one row per block) with ``start``: the sum of the blocks before."""
    until = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    grouped = sums.withColumn("_group", F.floor(F.col(block) / _GROUP))
    groups = grouped.groupBy(*by, "_group").agg(F.sum(value).alias("_sum"))
    over = Window.partitionBy(*by).orderBy("_group") if by else Window.orderBy("_group")
    groups = groups.select(*by, "_group", F.sum("_sum").over(until(over)).alias("_before"))
    inside = Window.partitionBy(*by, "_group").orderBy(block)
    return (
        grouped.withColumn("_inside", F.sum(value).over(until(inside)))
        .join(groups, [*by, "_group"])
        .select(
            *by, block, value, (F.coalesce("_before", F.lit(0)) + F.coalesce("_inside", F.lit(0))).alias("start")
        )
    )


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """(source, source_size) to (source, rank, source_size, docs, target).

    Sources in code point order, NULL last, take the weights in turn and share all words
    by weight. A target stops at three times its source's size; what is above goes to the
    others by weight. Equivalently there is one level: a target is level times weight, or
    the stop if that is less. With sources sorted by stop per weight the level is the
    share of what the stopped ones before leave, at the first source that is not stopped.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    rank = F.row_number().over(by_name)
    ranked = sizes.withColumn("rank", rank).withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1)
    )
    stop = (F.col("source_size") * REPEATS).alias("stop")
    order = Window.orderBy(F.col("stop") / F.col("weight"), "rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    filled = ranked.select("*", stop).select(
        "*",
        (F.sum("source_size").over(everything) - F.coalesce(F.sum("stop").over(before), F.lit(0))).alias("rest"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("weights"),
    )
    fits = F.col("rest").cast("double") * F.col("weight") / F.col("weights") <= F.col("stop")
    level = F.min(F.when(fits, F.struct("_at", "rest", "weights"))).over(everything)
    levelled = (
        filled.withColumn("_at", F.row_number().over(order)).withColumn("level", level)
    )
    share = F.col("level.rest").cast("double") * F.col("weight") / F.col("level.weights")
    return levelled.select(
        "source", "rank", "source_size", "docs", F.least(share, F.col("stop").cast("double")).alias("target")
    )


def _entries() -> Column:
    """A document's places in the merged queue: (finish, rank, turn, key), one per turn."""
    turns = F.least(F.lit(REPEATS), F.floor(F.col("target") / F.col("source_size")) + 1).cast("int")
    finish = lambda e: (e * F.col("source_size") + F.col("_sent")).cast("double") / F.col("target")
    return F.when(
        (F.col("source_size") > 0) & (F.col("target") > 0),
        F.transform(
            F.sequence(F.lit(0), turns - 1),
            lambda e: F.struct(finish(e).alias("finish"), F.col("rank"), e.alias("turn"), F.col("_key").alias("key")),
        ),
    ).otherwise(F.array().cast("array<struct<finish:double,rank:int,turn:int,key:string>>"))


def mixed(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, copies, taken.

    Size is the number of words; NULL or empty texts have none and ``taken`` 0. NULL
    sources are one source, the last. The shuffle is by the MD5 of id and text, so reruns
    agree; equal rows are interchangeable. If no document has words all targets are 0.
    An empty table gives no rows; other columns are not read.
    """
    text = whole(F.col("text"))
    key = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("|"), text))
    sized = staged(
        docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), key.alias("_key")), "mix-sizes"
    )
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    targets = source_targets(per_source, weights).withColumnRenamed("source", "_source")
    part = F.conv(F.substring("_key", 1, 8), 16, 10).cast("long") / F.lit(float(2**32))
    block = F.floor(part * F.ceil(F.col("docs") / BLOCK_ROWS)).alias("_block")
    queued = sized.join(targets, F.col("source").eqNullSafe(F.col("_source"))).select(
        "doc_id", "source", "size", "_key", "rank", "source_size", "target", block
    )
    sums = queued.groupBy("rank", "_block").agg(F.sum("size").alias("_words"))
    starts = _block_starts(sums, ["rank"], "_block", "_words").drop("_words")
    queue = Window.partitionBy("rank", "_block").orderBy("_key", "size")
    sent = F.col("start") + F.sum("size").over(queue.rowsBetween(Window.unboundedPreceding, 0))
    placed = staged(
        queued.join(starts, ["rank", "_block"]).withColumn("_sent", sent).withColumn("entries", _entries()),
        "mix-queue",
    )
    cut = _cut(placed)
    taken = F.lit(0) if cut is None else F.size(F.filter("entries", lambda e: e <= cut))
    return placed.select(
        "doc_id", "source", "size", "source_size", "target", taken.alias("copies"),
        (F.col("size") * taken).cast("long").alias("taken"),
    )


def _cut(placed: DataFrame) -> Column | None:
    """The last entry of the merged queue that fits the budget, or None if none does.

    Two rows reach the driver: the totals, and the entry.
    """
    total, rows = placed.agg(F.sum("size"), F.count(F.lit(1))).first()
    if not total:
        return None
    blocks = -(-rows // BLOCK_ROWS)
    entries = placed.select("size", F.explode("entries").alias("e")).withColumn(
        "_block", F.floor(F.col("e.finish") * blocks)
    )
    sums = entries.groupBy("_block").agg(F.sum("size").alias("_words"))
    starts = _block_starts(sums, [], "_block", "_words")
    over = starts.where(F.col("start") + F.col("_words") > total).agg(F.min("_block")).first()[0]
    if over is None:
        last = entries.agg(F.max("e").alias("e"))
    else:
        start = starts.where(F.col("_block") == over).first()["start"]
        inside = Window.partitionBy("_block").orderBy("e").rowsBetween(Window.unboundedPreceding, 0)
        fits = F.lit(start) + F.sum("size").over(inside) <= total
        near = entries.where(F.col("_block") == over).select("e", fits.alias("_fits")).where("_fits")
        here = near.agg(F.max("e").alias("e")).where("e IS NOT NULL")
        last = here if here.head(1) else entries.where(F.col("_block") < over).agg(F.max("e").alias("e"))
    e = last.first()["e"]
    if e is None:
        return None
    return F.struct(
        F.lit(e["finish"]).alias("finish"), F.lit(e["rank"]).alias("rank"),
        F.lit(e["turn"]).alias("turn"), F.lit(e["key"]).alias("key"),
    )
