"""Near duplicates: universal hash minima, banding, verification, connected components.

Texts with equal shingle sets form a class, found by a 128-bit fingerprint; only the
class's least document goes on. Minima of 160 hash functions make 40 band keys of four:
a pair with similarity 0.75 shares none with probability 3e-7. Documents that share a
band key are candidates:

1. In each band the document of least priority is the pivot; all others are compared
   with it. Signatures first, then, for what they leave, whole shingle sets.
2. Links give components. What is in one component needs no further comparison. Buckets
   that still hold several components take a second pivot, a different one in each band.
3. Buckets that even then hold several components are cut into blocks, and each two blocks meet in a
   task: a pair of different components is looked at in the first band it shares, by
   signatures five times as long and, of texts of up to 1024 shingles, by all of these in
   32 bits. Only pairs that may well be links leave the task, and are verified on whole
   sets like the others.

No bucket is gathered in a task and no bucket's pairs are written out: pivots come from
aggregates, blocks and groups of texts have bounded sizes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billweave.llm.components import components
from billweave.llm.shingles import Minima, mix, rows, shared, shingle_set
from billweave.staging import staged

BANDS = 40
ROWS = 4
SEED = 9
#: Signatures that agree in fewer places rule a pair out: six standard deviations below.
AGREE = 0.55
#: Long signatures for what is left, and their limit: likewise beyond five deviations.
LONG = 768
LONG_AGREE = 0.664
#: Sets of up to so many shingles meet whole, in 32 bits each; a pair may be off by this much.
SHORT, SHORT_SLACK = 1024, 0.5
#: So many members of a bucket make a block.
BLOCK = 1024
#: So many texts are compared with a copy of the pivot's text in one group.
GROUP = 200


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    minima = Minima(BANDS * ROWS, SEED)
    weights = np.arange(1, ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) | np.uint64(1)
    names = ["doc_id", "n_shingles", "set_a", "set_b", "bands", "signature"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()]
    out: list[tuple] = []
    for doc_id, text in rows(batches):
        found = shingle_set(text)
        if len(found):
            least = minima.of(found)
            bands = mix((mix(least).reshape(BANDS, ROWS) * weights).sum(axis=1, dtype=np.uint64))
            a, b = mix(found).sum(dtype=np.uint64), np.bitwise_xor.reduce(mix(found ^ np.uint64(0xA5A5)))
            out.append((
                doc_id, len(found), int(a.astype(np.int64)), int(b.astype(np.int64)),
                bands.astype(np.int64), (least >> np.uint64(48)).astype(np.uint16).tobytes(),
            ))
        else:
            out.append((doc_id, 0, 0, 0, None, None))
        if len(out) == 500:
            yield _batch(out, names, kinds)
            out = []
    if out:
        yield _batch(out, names, kinds)


def _batch(out: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(column), kind) for column, kind in zip(zip(*out, strict=True), kinds, strict=True)], names
    )


def _agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose signatures agree often enough."""
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b = (
            np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint16).reshape(batch.num_rows, -1) for k in (2, 3)
        )
        keep = pa.array((a == b).mean(axis=1) >= AGREE)
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["a", "b"])


def _compared(percent: int):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by (a, part), the pivot's own texts first."""
        group, pivots = None, []
        out: list[tuple] = []
        for a, part, other, node, text in rows(batches):
            found = shingle_set(text)
            if (a, part) != group:
                group, pivots = (a, part), []
            if not other:
                pivots.append(found)
            elif any(_similar(pivot, found, percent) for pivot in pivots):
                out.append((a, node))
            if len(out) == 10_000:
                yield _batch(out, ["a", "b"], [pa.int64()] * 2)
                out = []
        if out:
            yield _batch(out, ["a", "b"], [pa.int64()] * 2)

    return compare


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if not len(a) or not len(b):
        return False
    both = shared(a, b)
    return 100 * both >= percent * (len(a) + len(b) - both)


def _long_signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    minima = Minima(LONG, SEED + 1)
    out: list[tuple] = []
    for node, text in rows(batches):
        found = shingle_set(text)
        short = np.unique((found >> np.uint64(32)).astype(np.uint32)) if len(found) <= SHORT else found[:0]
        out.append((node, (mix(minima.of(found)) >> np.uint64(56)).astype(np.uint8).tobytes(), short.tobytes()))
        if len(out) == 500:
            yield _batch(out, ["node", "long", "short"], [pa.int64(), pa.binary(), pa.binary()])
            out = []
    if out:
        yield _batch(out, ["node", "long", "short"], [pa.int64(), pa.binary(), pa.binary()])


def _nearly(a: bytes, b: bytes, percent: int) -> bool:
    """Whether short sets are similar up to the slack; a long text's set is not there."""
    if not a or not b:
        return True
    a, b = np.frombuffer(a, np.uint32), np.frombuffer(b, np.uint32)
    both = shared(a, b)
    return 100 * both >= (percent - SHORT_SLACK) * (len(a) + len(b) - both)


def _likely(members: list[tuple], one: bool, percent: int) -> list[tuple[int, int]]:
    """Pairs of different labels, in the first band they share, that may well be similar enough."""
    sides = [[m for m in members if m[0] == side] for side in ((0,) if one else (0, 1))]
    left, right = sides[0], sides[-1]
    if not left or not right:
        return []
    label = np.array([m[3] for m in right])
    bands = np.array([m[4] for m in right])
    long = np.frombuffer(b"".join(m[5] for m in right), np.uint8).reshape(len(right), -1)
    found = []
    for i, (_, pos, node, own, own_bands, own_long, short) in enumerate(left):
        apart = label != own
        if one:
            apart[: i + 1] = False
        at = np.flatnonzero(apart)
        at = at[(bands[at] == np.array(own_bands)).argmax(axis=1) == pos]
        at = at[(long[at] == np.frombuffer(own_long, np.uint8)).mean(axis=1) >= LONG_AGREE]
        at = [j for j in at.tolist() if _nearly(short, right[j][6], percent)]
        found += [(min(node, right[j][2]), max(node, right[j][2])) for j in at]
    return found


def _met_blocks(percent: int):
    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by (key, lo, hi): the members of one or two blocks of a bucket."""
        group, members, out = None, [], []
        for key, lo, hi, *member in rows(batches):
            if (key, lo, hi) != group:
                if members:
                    out += _likely(members, group[1] == group[2], percent)
                group, members = (key, lo, hi), []
            members.append(tuple(member))
            if len(out) > 10_000:
                yield _batch(out, ["a", "b"], [pa.int64()] * 2)
                out = []
        if members:
            out += _likely(members, group[1] == group[2], percent)
        if out:
            yield _batch(out, ["a", "b"], [pa.int64()] * 2)

    return meet


def _open_buckets(members: DataFrame, label: DataFrame) -> DataFrame:
    """(key, pos, node, label) of the buckets that hold several components."""
    labelled = members.join(label, "node", "left").select(
        "key", "pos", "node", F.coalesce("label", "node").alias("label")
    )
    several = labelled.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi")
    return staged(labelled.join(several.select("key"), "key", "left_semi"), "near-open")


def _second_pivots(open_: DataFrame) -> DataFrame:
    """Members of open buckets with another pivot, each band choosing its own."""
    order = F.struct(F.xxhash64("node", "pos").alias("order"), "node", "label")
    pivots = staged(
        open_.groupBy("key").agg(F.min(order).alias("p")).select("key", F.col("p.node").alias("pivot"), F.col("p.label").alias("own")),
        "near-pivots",
    )
    return open_.join(pivots, "key").where("node <> pivot")


def _rest(open_: DataFrame, nodes: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Likely pairs (a, b) of different components in buckets, block by block."""
    parts = open_.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("parts"))
    mixed = staged(open_.join(parts, "key"), "near-mixed")
    wanted = mixed.select("node").distinct()
    long = texts.join(wanted, "node").select("node", "text").mapInArrow(_long_signatures, "node long, long binary, short binary")
    sides = staged(long.dropDuplicates(["node"]).join(nodes.select("node", "bands"), "node"), "near-long")
    own = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    met = (
        mixed.select("key", "pos", "node", "label", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("met"))
        .select(
            "key", F.least("own", "met").alias("lo"), F.greatest("own", "met").alias("hi"),
            F.when(F.col("own") <= F.col("met"), 0).otherwise(1).alias("side"), "pos", "node", "label",
        )
        .join(sides, "node")
        .select("key", "lo", "hi", "side", "pos", "node", "label", "bands", "long", "short")
        .repartition("key", "lo", "hi")
        .sortWithinPartitions("key", "lo", "hi")
    )
    return met.mapInArrow(_met_blocks(percent), "a long, b long").distinct()


def _agreed(signatures: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) whose signatures agree often enough."""
    signed = (
        pairs.join(signatures.toDF("a", "sig_a"), "a")
        .join(signatures.toDF("b", "sig_b"), "b")
        .select("a", "b", "sig_a", "sig_b")
    )
    return signed.mapInArrow(_agreeing, "a long, b long")


def _verified(texts: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The distinct pairs (a, b) whose whole sets are similar enough.

    ``a`` is met by many; its text goes once to each group of ``b`` texts.
    """
    pairs = staged(pairs, "near-pairs")
    parts = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / GROUP).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("b"), F.col("parts")).cast("int")
    needed = parts.select(
        F.col("a").alias("node"), "a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        F.lit(0).alias("other"),
    ).union(pairs.join(parts, "a").select(F.col("b").alias("node"), "a", part.alias("part"), F.lit(1).alias("other")))
    dealt = (
        texts.join(needed, "node")
        .select("a", "part", "other", "node", "text")
        .repartition("a", "part")
        .sortWithinPartitions("a", "part", "other")
    )
    return staged(dealt.mapInArrow(_compared(percent), "a long, b long"), "near-links")


def near_duplicates(docs: DataFrame, percent: int = 75) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Linked are documents that share ``percent`` of the five-word shingles of both. The
    component is named by its least doc_id, the one that is kept. A text without words,
    or NULL, has no shingles and is linked with nothing; so is a row without doc_id,
    whose component is NULL and which is kept. Rows that share an id are one document,
    linked by any of its texts, and get equal verdicts. Very long texts are compared whole.
    An empty table gives no rows. Other columns are not read.
    """
    binary = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    described = staged(
        binary.mapInArrow(
            _described,
            "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>, signature binary",
        ),
        "near-described",
    )
    linkable = described.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = staged(linkable.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("node")), "near-classes")
    nodes = linkable.join(classes, ["set_a", "set_b"]).where("doc_id = node")
    signatures = nodes.select("node", "signature")

    # An id with several texts links their classes, however unlike they are.
    placed = linkable.select("doc_id", "set_a", "set_b").join(classes, ["set_a", "set_b"]).select("doc_id", "node")
    least = placed.groupBy("doc_id").agg(F.min("node").alias("b"), F.max("node").alias("most")).where("b < most")
    same = staged(
        placed.join(least, "doc_id").where("node <> b").select(F.col("node").alias("a"), "b").distinct(), "near-same-id"
    )

    keyed = nodes.select("node", F.posexplode("bands").alias("pos", "key"))
    priority = F.struct(F.xxhash64("node").alias("order"), "node")
    # Written, so that both sides of the join are plain and a key with very many nodes is split.
    pivots = staged(
        keyed.groupBy("key")
        .agg(F.min(priority).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("key", F.col("first.node").alias("pivot")),
        "near-pivots",
    )
    members = staged(keyed.join(pivots, "key"), "near-buckets")
    texts = staged(
        binary.withColumnRenamed("doc_id", "node").join(members.select("node").distinct(), "node"), "near-texts"
    )
    first = members.where("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    links = _verified(texts, _agreed(signatures, first), percent)
    label = lambda: components(links.toDF("u", "v")).withColumnRenamed("component", "label")
    open_ = _open_buckets(members.where("node <> pivot").select("key", "pos", "node"), label())
    met = _second_pivots(open_)
    second = met.where("label <> own").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    links = links.union(_verified(texts, _agreed(signatures, second), percent))
    open_ = _open_buckets(met.select("key", "pos", "node"), label())
    links = links.union(_verified(texts, _rest(open_, nodes, texts, percent), percent))

    found = components(links.union(same).toDF("u", "v"))
    return (
        described.select("doc_id", "n_shingles", "set_a", "set_b")
        .join(classes, ["set_a", "set_b"], "left")
        .join(found, "node", "left")
        .select(
            "doc_id", "n_shingles",
            F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "node", "doc_id")).alias("component_id"),
        )
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def distinct_documents(docs: DataFrame, percent: int = 75) -> DataFrame:
    """The rows of ``docs`` whose document is kept; columns unchanged.

    Rows without id, and texts without words, are kept. All rows of a kept id are, also
    with unlike texts. An empty table stays empty.
    """
    gone = near_duplicates(docs, percent).where("NOT kept").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")
