"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billweave.staging import staged


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang neighbours of a node on the least of them and itself.

    ``edges`` has (u, v), v < u. Large-star sees both directions and moves larger
    neighbours, small-star sees smaller neighbours and moves them and the node. The least
    neighbour is an aggregate, so a node with very many neighbours is no group in a task,
    and the join back can be split by the adaptive planner.
    """
    if large:
        seen = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        seen = edges.select("u", "v")
    least = seen.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    hung = seen.join(least, "u")
    if large:
        moved = hung.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = hung.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v"))
        )
    return moved.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, v) of longs to (node, component): the least node reachable; linked nodes only.

    Each round is written to the shared folder, so lineage stays short. Rounds end when
    two in a row have equal edges, told by their number and two sums of hashes; their
    number grows with the logarithm of the nodes. Loops and repeated links do no harm.
    """
    current = staged(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        "component-links",
    )
    print_of = lambda df: tuple(
        df.agg(
            F.count(F.lit(1)),
            F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
            F.bit_xor(F.xxhash64("v", "u")),
        ).first()
    )
    known = print_of(current)
    while known[0]:
        current = staged(_star(_star(current, large=True), large=False), "component-stars")
        now = print_of(current)
        if now == known:
            break
        known = now
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
