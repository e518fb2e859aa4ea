"""Benchmark items inside documents: size-partitioned minima search, exact verification.

Items are parted by size: class c holds those with 2^c up to 2^(c+1) - 1 shingles. For
each class a document's shingles, in the order of the text, are cut into blocks of 2^c,
and each block has the minimum of every hash function. An item is a candidate if one of
its own minima is also that of a block. The least shingle of an item is in a document
that contains three quarters of it with probability 0.75, and is then the least of its
block with probability at least one half, wherever the shingles stand; 48 functions all
miss with probability 0.625^48 = 2e-10. Long texts so lose nothing to their length.
Candidates are verified on whole shingle sets.

The items are the stated query set: they go to the tasks in blocks of bounded size, one
pass over the documents for each; documents are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billweave.llm.shingles import Minima, mix, rows, sequence, shared
from billweave.staging import staged

FUNCTIONS = 48
SEED = 10
#: So many shingles of items go to the tasks at once, at most, unless one item has more.
BLOCK_SHINGLES = 1_000_000


def _item_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = []
    for item_id, text in rows(batches):
        found = np.unique(sequence(text))
        if len(found):
            out.append((item_id, len(found), found.tobytes()))
    names, kinds = ["item_id", "n", "shingles"], [pa.int64(), pa.int64(), pa.binary()]
    columns = list(zip(*out, strict=True)) or [(), (), ()]
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


class Items:
    """A block of items, ready to be searched for; what tasks are sent."""

    def __init__(self, found: list[tuple[int | None, bytes]]) -> None:
        self.ids = [item for item, _ in found]
        self.sets = [np.frombuffer(data, np.uint64) for _, data in found]
        minima = Minima(FUNCTIONS, SEED)
        keys: dict[int, list] = {}
        for at, values in enumerate(self.sets):
            keys.setdefault(len(values).bit_length() - 1, []).append((self._keys(minima.of(values)[:, None]), at))
        self.classes = {}
        for size, of_class in sorted(keys.items()):
            flat = np.concatenate([k.ravel() for k, _ in of_class])
            owner = np.repeat([at for _, at in of_class], FUNCTIONS)
            order = np.argsort(flat, kind="stable")
            bits = max(12, int(64 * len(flat)).bit_length())
            marks = np.zeros(1 << bits, bool)
            marks[flat >> np.uint64(64 - bits)] = True
            self.classes[size] = (flat[order], owner[order], marks, np.uint64(64 - bits))

    @staticmethod
    def _keys(minima: np.ndarray) -> np.ndarray:
        """One value for a minimum and its function."""
        return mix(minima + np.arange(FUNCTIONS, dtype=np.uint64)[:, None])

    def candidates(self, minima: Minima, found: np.ndarray) -> set[int]:
        near: set[int] = set()
        if not self.classes:
            return near
        size = min(self.classes)
        least = minima.of_blocks(found, 1 << size)
        for wanted, (keys, owner, marks, shift) in self.classes.items():
            while size < wanted:
                if least.shape[1] % 2:
                    least = np.concatenate([least, least[:, -1:]], axis=1)
                least = np.minimum(least[:, ::2], least[:, 1::2])
                size += 1
            here = self._keys(least).ravel()
            here = here[marks[here >> shift]]
            if len(here):
                left, right = np.searchsorted(keys, here), np.searchsorted(keys, here, side="right")
                for a, b in zip(left[left < right], right[left < right], strict=True):
                    near.update(owner[a:b].tolist())
        return near

    def inside(self, minima: Minima, text: bytes | None, percent: int) -> list[tuple[int, int]]:
        """(item, shared shingles) for the items of which the text has ``percent``."""
        found = sequence(text)
        if not len(found):
            return []
        near = self.candidates(minima, found)
        if not near:
            return []
        whole = np.unique(found)
        counts = [(at, shared(self.sets[at], whole)) for at in sorted(near)]
        return [(at, n) for at, n in counts if 100 * n >= percent * len(self.sets[at])]


def item_blocks(items: DataFrame) -> list[Items]:
    """The items in blocks; their number follows from the measured total."""
    described = staged(
        items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("binary").alias("text"))
        .mapInArrow(_item_rows, "item_id long, n long, shingles binary"),
        "benchmark-items",
    )
    blocks = 1
    while True:
        block = F.pmod(F.xxhash64("shingles"), F.lit(blocks))
        sizes = described.groupBy(block.alias("block")).agg(F.sum("n").alias("n"), F.count_distinct("shingles").alias("k"))
        if not sizes.where((F.col("n") > BLOCK_SHINGLES) & (F.col("k") > 1)).head(1):
            break
        blocks *= 2
    parted = described.withColumn("block", block)
    return [
        Items([(r["item_id"], bytes(r["shingles"])) for r in parted.where(F.col("block") == b).toLocalIterator()])
        for b in range(blocks)
    ]


def contained_items(docs: DataFrame, items: DataFrame, percent: int = 75) -> DataFrame:
    """(doc_id, item_id, item_shingles, shared_shingles, containment) of items in documents.

    A document contains an item if it has at least ``percent`` of the item's distinct
    five-word shingles. An item with fewer words is one shingle, which only documents of
    just these words have. Items and texts that are NULL or have no words match nothing.
    Repeated rows give repeated results; NULL ids are passed through. Other columns are
    not read. Without documents or items there are no rows.
    """
    schema = "doc_id long, item_id long, item_shingles long, shared_shingles long, containment double"
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))

    def search(block: Items):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            minima = Minima(FUNCTIONS, SEED)
            for batch in batches:
                out = []
                for doc_id, text in rows(iter([batch])):
                    for at, n in block.inside(minima, text, percent):
                        of = len(block.sets[at])
                        out.append((doc_id, block.ids[at], of, n, n / of))
                columns = list(zip(*out, strict=True)) or [()] * 5
                kinds = [pa.int64()] * 4 + [pa.float64()]
                names = ["doc_id", "item_id", "item_shingles", "shared_shingles", "containment"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        return run

    found = [texts.mapInArrow(search(block), schema) for block in item_blocks(items)]
    result = found[0]
    for more in found[1:]:
        result = result.union(more)
    return result


def clean_documents(docs: DataFrame, items: DataFrame, percent: int = 75) -> DataFrame:
    """The rows of ``docs`` that contain no item; columns unchanged, nothing shuffled."""
    at = docs.columns.index("text")

    def keep(block: Items):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            minima = Minima(FUNCTIONS, SEED)
            for batch in batches:
                texts = batch.column(at)
                clean = [
                    not block.inside(minima, text.as_py().encode() if text.is_valid else None, percent) for text in texts
                ]
                yield batch.filter(pa.array(clean, pa.bool_()))

        return run

    for block in item_blocks(items):
        docs = docs.mapInArrow(keep(block), docs.schema)
    return docs
