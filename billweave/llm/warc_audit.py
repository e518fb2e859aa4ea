"""Fixity audit of WARC replicas by Merkle trees over records and offset ranges.

A leaf is a record's SHA-256. A node of level 0 hashes the records that start in a range
of 64 KiB of its file, in the order of offsets; a node above hashes up to 16 neighbouring
nodes below. Roots of two replicas are compared first; each further join only reads the
children of nodes that differ, down to the ranges and then the records.

Every group is bounded by the range or the fan-out, so a file with a third of all records
is many small groups; its offsets are running totals in blocks of the order. Records
without offset are dealt to nodes below zero by their hash. Trees lie in the shared
folder, one table per level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from billweave.llm.mixing import _block_starts
from billweave.staging import staged

RANGE = 64 * 1024
FAN = 16
#: Levels above the first; a node of the last covers RANGE * FAN^4, four gibibytes.
LEVELS = 4
#: Copies of a record are made in pieces of so many.
_COPIES = 4096
PAGES_PER_FILE = 256


def warc_record(url: Column, page_id: Column, html: Column) -> Column:
    """A WARC resource record as text; NULLs are empty."""
    or_empty = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Target-URI: "), or_empty(url),
        F.lit("\r\nWARC-Record-ID: <urn:page:"), or_empty(page_id),
        F.lit(">\r\nContent-Length: "), F.octet_length(or_empty(html)).cast("string"),
        F.lit("\r\n\r\n"), or_empty(html), F.lit("\r\n\r\n"),
    )


def warc_layout(pages: DataFrame) -> DataFrame:
    """(file, offset, length, digest, page_id) of the pages as WARC files.

    A file holds the pages of ``PAGES_PER_FILE`` ids in the order of ids, then of urls and
    contents; pages without id are dealt to files by their MD5. Repeated rows are
    repeated records. Rows come in the order of files and offsets.
    """
    record = warc_record(F.col("url"), F.col("page_id"), F.col("html"))
    made = pages.select(
        "page_id",
        F.coalesce(F.col("url"), F.lit("")).alias("url"),
        F.octet_length(record).cast("long").alias("length"),
        F.sha2(record.cast("binary"), 256).alias("digest"),
    )
    by_id = F.concat(F.lit("pages-"), F.floor(F.col("page_id") / PAGES_PER_FILE).cast("string"))
    by_hash = F.concat(F.lit("pages-x"), F.substring("digest", 1, 3))
    files = made.withColumn("file", F.coalesce(by_id, by_hash))
    order = ["file", "page_id", "url", "digest"]
    once = staged(files.groupBy(*order, "length").agg(F.count(F.lit(1)).alias("n")), "warc-records")
    # Written, so that a row's block stays what the ranges of the order made it.
    blocks = staged(
        once.repartitionByRange(*order).select("*", (F.col("n") * F.col("length")).alias("size"), F.spark_partition_id().alias("block")),
        "warc-blocks",
    )
    starts = _block_starts(blocks.groupBy("file", "block").agg(F.sum("size").alias("size")), ["file"], "block", "size")
    before = Window.partitionBy("file", "block").orderBy("page_id", "url", "digest").rowsBetween(Window.unboundedPreceding, -1)
    inside = blocks.withColumn("at", F.coalesce(F.sum("size").over(before), F.lit(0)))
    placed = inside.join(starts.select("file", "block", "start"), ["file", "block"]).select(
        "file", (F.col("start") + F.col("at")).alias("first"), "length", "digest", "page_id", "n"
    )
    placed = staged(placed, "warc-placed")
    pieces = placed.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / _COPIES))))
    copy = F.explode(F.sequence(F.col("piece") * _COPIES, F.least("n", (F.col("piece") + 1) * _COPIES) - 1)).alias("copy")
    made = pieces.select("file", "first", "length", "digest", "page_id", copy)
    offset = (F.col("first") + F.col("copy") * F.col("length")).alias("offset")
    return made.select("file", offset, "length", "digest", "page_id").orderBy("file", "offset")


def _range() -> Column:
    """The node of level 0; records without offset lie below zero, in one node of the last level."""
    below = -1 - F.pmod(F.xxhash64("length", "digest"), F.lit(FAN**LEVELS))
    return F.coalesce(F.floor(F.col("offset") / RANGE), below)


def _hashed(parted: DataFrame) -> DataFrame:
    return parted.groupBy("file", "node").agg(
        F.sha2(F.array_join(F.sort_array(F.collect_set("child"))["part"], ",").cast("binary"), 256).alias("hash")
    )


def _parents(nodes: DataFrame, node: Column) -> DataFrame:
    part = F.concat_ws(":", F.col("node").cast("string"), "hash").alias("part")
    return nodes.select("file", node.alias("node"), F.struct(F.col("node").alias("offset"), part).alias("child"))


def merkle_tree(records: DataFrame) -> list[DataFrame]:
    """Nodes (file, node, hash) of each level, from the ranges up to the roots.

    ``records`` has file, offset, length and digest. NULL files are one file, records
    without offset lie in ranges of their own. Equal rows count once. A file beyond four
    gibibytes, or with records without offset, has several nodes in the last level;
    ``roots`` joins them.
    """
    leaf = F.concat_ws(":", F.coalesce("offset", F.lit(-1)).cast("string"), F.col("length").cast("string"), "digest")
    parted = records.select(
        F.coalesce("file", F.lit("")).alias("file"),
        _range().alias("node"),
        F.struct(F.col("offset"), leaf.alias("part")).alias("child"),
    )
    levels = []
    for level in range(LEVELS + 1):
        levels.append(staged(_hashed(parted), f"merkle-{level}"))
        parted = _parents(levels[-1], F.floor(F.col("node") / FAN))
    return levels


def roots(levels: list[DataFrame]) -> DataFrame:
    """(file, hash), one row per file.

    The hash is that of the file's only node in the last level; of several, levels are
    added until two are left at most, for offsets and for records without, which are
    hashed together.
    """
    top, done = levels[-1], []
    while not (wide := top.where("node > 0").select("file").distinct()).isEmpty():
        done.append(top.join(wide, "file", "left_anti"))
        top = staged(_hashed(_parents(top.join(wide, "file", "left_semi"), F.floor(F.col("node") / FAN))), "merkle-above")
    for nodes in done:
        top = top.union(nodes)
    only = top.groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.first("hash").alias("only"))
    both = _hashed(_parents(top, F.lit(0))).select("file", "hash")
    return only.join(both, "file").select("file", F.when(F.col("n") == 1, F.col("only")).otherwise(F.col("hash")).alias("hash"))


def _differing(a: DataFrame, b: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Keys whose value differs or is on one side only."""
    both = a.select(*keys, F.col(value).alias("_a")).join(b.select(*keys, F.col(value).alias("_b")), keys, "full")
    return both.where(~F.col("_a").eqNullSafe(F.col("_b")))


def differing_ranges(a: list[DataFrame], b: list[DataFrame]) -> DataFrame:
    """(file, node) of level 0 that differ, found from the roots down."""
    found = _differing(a[-1], b[-1], ["file", "node"], "hash").select("file", "node")
    for level in range(LEVELS - 1, -1, -1):
        parents = found.withColumnsRenamed({"file": "_file", "node": "_node"})
        below = lambda nodes: nodes.join(
            parents,  # noqa: B023
            (F.col("file") == F.col("_file")) & (F.floor(F.col("node") / FAN) == F.col("_node")),
            "left_semi",
        )
        found = _differing(below(a[level]), below(b[level]), ["file", "node"], "hash").select("file", "node")
    return found


def audit(primary: DataFrame, replica: DataFrame, trees: tuple[list[DataFrame], list[DataFrame]] | None = None) -> DataFrame:
    """(file, offset, status, primary_digest, replica_digest) of records that differ.

    Status is "changed", "missing" (from the replica) or "extra"; a record without offset,
    shown at -1, has no place to be changed at. Only records in ranges that differ are
    read. Two empty replicas, or equal ones, give no rows.
    """
    a, b = trees or (merkle_tree(primary), merkle_tree(replica))
    ranges = staged(differing_ranges(a, b).withColumnsRenamed({"file": "_file", "node": "_node"}), "merkle-ranges")

    def inside(records: DataFrame, name: str) -> DataFrame:
        named = records.withColumn("file", F.coalesce("file", F.lit("")))
        near = named.join(ranges, (F.col("file") == F.col("_file")) & (_range() == F.col("_node")), "left_semi")
        print_ = F.concat_ws(":", F.col("length").cast("string"), "digest")
        loose = F.when(F.col("offset").isNull(), print_).otherwise("").alias("loose")
        return near.select("file", F.coalesce("offset", F.lit(-1)).alias("offset"), loose, print_.alias("print"), F.col("digest").alias(name)).distinct()

    both = inside(primary, "primary_digest").join(
        inside(replica, "replica_digest").withColumnRenamed("print", "other"), ["file", "offset", "loose"], "full"
    )
    status = F.when(F.col("other").isNull(), "missing").when(F.col("print").isNull(), "extra").otherwise("changed")
    return both.where(~F.col("print").eqNullSafe(F.col("other"))).select(
        "file", "offset", status.alias("status"), "primary_digest", "replica_digest"
    )
