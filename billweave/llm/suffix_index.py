"""Long repeats by a logarithmic family of sparse suffix arrays.

A byte goes if a string of 200 bytes that covers it also starts anywhere else. Of all
suffixes those are indexed that start at an anchor: among the 50-byte windows of a
200-byte string the anchor is the one of least hash (the first of equals), so equal
strings have equal anchors at equal places. Successive strings mostly share an anchor; an
entry of the index stands for one anchor and all its strings, with two hashes: ``kfp`` of
the suffix's first 50 bytes, by which arrays are ordered, and ``nfp`` of all bytes that
the anchor's strings cover. Order among unequal prefixes is that of their hashes.

Documents come in batches. A batch's array is written sorted and bucketed by ``kfp``,
merge-scanned against each existing level without a shuffle, and added as a new level;
before that, levels of equal rank are merged, so there are logarithmically many. Entries
with equal ``nfp`` repeat as a whole. Entries that only share ``kfp`` may have some
strings in common: their bytes are compared string by string, class by class.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billweave.llm.shingles import mix, prefix_hashes, range_hashes, rows, window_ranks
from billweave.staging import new_folder, remove_folder, staged

LENGTH = 200
PREFIX = 50
BATCHES = 4
#: A class with more entries than this is compared through rows, not inside one task.
CLASS_ROWS = 50_000
_PLACE_BITS = np.uint64(28)
#: Texts are hashed together up to about so many bytes.
_CHUNK = 1 << 17


def anchors(texts: list[bytes], length: int, prefix: int) -> tuple[np.ndarray, ...]:
    """Entries of some texts: (text, first, offset, more, kfp, nfp).

    ``first`` is where the first string of the anchor starts, ``offset`` from there to
    the anchor, ``more`` the number of further strings, each a byte later.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    begins = np.cumsum(sizes) - sizes
    strings = np.maximum(sizes - length + 1, 0)
    total = int(strings.sum())
    if not total:
        return tuple(np.empty(0, np.int64) for _ in range(6))
    data = np.frombuffer(b"".join(texts), np.uint8)
    sums = prefix_hashes(data)
    ranks = window_ranks(sums, prefix)
    ranks = (ranks >> _PLACE_BITS << _PLACE_BITS) | np.arange(len(ranks), dtype=np.uint64)
    width = length - prefix + 1
    blocks = np.concatenate([ranks, np.full(-len(ranks) % width, 2**64 - 1, np.uint64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()

    text = np.repeat(np.arange(len(texts)), strings)
    start = np.arange(total) - np.repeat(np.cumsum(strings) - strings, strings) + np.repeat(begins, strings)
    least = np.minimum(back[start], ahead[start + width - 1])
    anchor = (least & np.uint64((1 << int(_PLACE_BITS)) - 1)).astype(np.int64)
    new = np.flatnonzero((np.diff(anchor, prepend=-1) != 0) | (np.diff(text, prepend=-1) != 0))
    last = np.append(new[1:], total) - 1
    first, final, anchor = start[new], start[last], anchor[new]
    kfp = range_hashes(sums, anchor, anchor + prefix)
    form = ((anchor - first) << 16 | (final - first)).astype(np.uint64)
    nfp = mix(range_hashes(sums, first, final + length) + mix(form))
    return text[new], first - begins[text[new]], anchor - first, final - first, kfp, nfp


def _chunks(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, list[bytes]]]:
    """Slices of a column of texts, as (first row, texts); NULL is empty."""
    some: list[bytes] = []
    begin, size = 0, 0
    for i, value in enumerate(batch.column(column)):
        text = value.as_py() or b""
        some.append(text)
        size += len(text)
        if size >= _CHUNK:
            yield begin, some
            begin, some, size = i + 1, [], 0
    if some:
        yield begin, some


def _longs(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64) if values.dtype == np.uint64 else values.astype(np.int64))


def _counted(length: int, prefix: int):
    """(kfp, nfp, n) of texts; equal entries of a task are added up before they leave it."""

    def flushed(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        kfp, nfp = (np.concatenate([f[k] for f in found]) for k in (0, 1))
        own, at, n = np.unique(nfp, return_index=True, return_counts=True)
        return pa.RecordBatch.from_arrays([_longs(kfp[at]), _longs(own), pa.array(n)], ["kfp", "nfp", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, size = [], 0
        for batch in batches:
            for _, texts in _chunks(batch, 0):
                *_, kfp, nfp = anchors(texts, length, prefix)
                if len(kfp):
                    found.append((kfp, nfp))
                    size += len(kfp)
                if size > 1_000_000:
                    yield flushed(found)
                    found, size = [], 0
        if found:
            yield flushed(found)

    return run


def _placed(length: int, prefix: int):
    """(nfp, doc, place) of every entry; a place is first, offset and more in one number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs = np.asarray(batch.column(0))
            for begin, texts in _chunks(batch, 1):
                text, first, offset, more, _, nfp = anchors(texts, length, prefix)
                if len(nfp):
                    place = first << 24 | offset << 12 | more
                    yield pa.RecordBatch.from_arrays(
                        [_longs(nfp), pa.array(docs[begin + text]), pa.array(place)], ["nfp", "doc", "place"]
                    )

    return run


def _unplaced(place: int) -> tuple[int, int, int]:
    return place >> 24, place >> 12 & 4095, place & 4095


class SuffixLevels:
    """The levels: bucketed tables of (kfp, nfp, n), n the number of equal entries."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[tuple[int, str, str]] = []

    def _written(self, entries: DataFrame) -> tuple[str, str]:
        """Equal entries added up, sorted by prefix hash, a file for each bucket."""
        name, path = f"suffix_level_{uuid.uuid4().hex}", new_folder(self.spark, "suffix-level")
        (
            entries.repartition(self.buckets, "kfp")
            .groupBy("kfp", "nfp")
            .agg(F.sum("n").alias("n"))
            .sortWithinPartitions("kfp", "nfp")
            .write.bucketBy(self.buckets, "kfp")
            .sortBy("kfp", "nfp")
            .option("path", path)
            .saveAsTable(name)
        )
        return name, path

    def _drop(self, name: str, path: str) -> None:
        self.spark.sql(f"DROP TABLE {name}")
        remove_folder(self.spark, path)

    def _compact(self) -> None:
        """Merge the two last levels while their ranks are equal."""
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (rank, *a), (_, *b) = self.levels.pop(), self.levels.pop()
            merged = self._written(self.spark.table(a[0]).union(self.spark.table(b[0])))
            self.levels.append((rank + 1, *merged))
            self._drop(*a)
            self._drop(*b)

    def add(self, entries: DataFrame) -> DataFrame:
        """Index a batch; returns (kfp, nfp, n) of all entries, old and new, whose prefix repeats.

        Only prefixes that the batch has are looked at: of others nothing has changed.
        """
        self._compact()
        name, path = self._written(entries)
        new = self.spark.table(name)
        within = new.groupBy("kfp").agg(F.sum("n").alias("all")).where("all > 1").select("kfp")
        mine = new.join(within, "kfp", "left_semi")
        older = []
        for _, level, _ in self.levels:
            old = self.spark.table(level)
            mine = mine.union(new.join(old, "kfp", "left_semi"))
            older.append(old.join(new, "kfp", "left_semi"))
        found = mine.distinct()
        for rows_ in older:
            found = found.union(rows_)
        matched = staged(found.groupBy("kfp", "nfp").agg(F.sum("n").alias("n")), "suffix-matches")
        self.levels.append((0, name, path))
        return matched

    def close(self) -> None:
        while self.levels:
            _, *table = self.levels.pop()
            self._drop(*table)


def _verdicts(matches: list[DataFrame]) -> DataFrame:
    """(nfp, state): "whole" repeats as it is, "mixed" too and has cousins, "single" has cousins only."""
    found = matches[0]
    for more in matches[1:]:
        found = found.union(more)
    entries = found.groupBy("kfp", "nfp").agg(F.max("n").alias("n"))
    cousins = entries.groupBy("kfp").agg(F.min("nfp").alias("lo"), F.max("nfp").alias("hi")).where("lo <> hi")
    state = F.when(F.col("n") == 1, F.when(F.col("lo").isNotNull(), "single")).otherwise(
        F.when(F.col("lo").isNotNull(), "mixed").otherwise("whole")
    )
    return entries.join(cousins, "kfp", "left").select("nfp", state.alias("state")).where("state IS NOT NULL")


def _runs(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if merged and a <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(merged[-1][1], b))
        else:
            merged.append((a, b))
    return merged


def _packed(spans: list[tuple[int, int]]) -> bytes:
    return np.array(spans, np.int64).tobytes()


def _unpacked(data: bytes) -> list[tuple[int, int]]:
    return [tuple(x) for x in np.frombuffer(data, np.int64).reshape(-1, 2).tolist()]


def _compressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, 256):
            part = batch.slice(i, 256)
            packed = [zlib.compress(t or b"", 1) for t in part.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(packed, pa.binary())], ["doc_id", "doc", "packed"])


_OPENED = pa.schema([
    ("doc_id", pa.int64()), ("doc", pa.int64()), ("packed", pa.binary()), ("removed", pa.binary()), ("open", pa.bool_()),
    ("contexts", pa.list_(pa.struct([("kfp", pa.int64()), ("place", pa.int64()), ("asks", pa.bool_()), ("bytes", pa.binary())]))),
])


def _opened(length: int, prefix: int):
    """Join whole repeats to spans; take out the bytes of entries to be compared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for doc_id, doc, packed, whole, single, shown in rows(batches):
            spans = []
            for place in whole or []:
                first, _, more = _unplaced(place)
                spans.append((first, first + more + length))
            contexts = []
            if single or shown:
                text = zlib.decompress(packed)
                asking = sorted(set(single or []))
                for place, asks in [(p, True) for p in asking] + [(p, False) for p in sorted(set(shown or []))]:
                    first, offset, more = _unplaced(place)
                    data = text[first : first + more + length]
                    begin = np.array([offset])
                    kfp = range_hashes(prefix_hashes(np.frombuffer(data, np.uint8)), begin, begin + prefix)
                    contexts.append({"kfp": int(kfp.view(np.int64)[0]), "place": place, "asks": asks, "bytes": data})
            out.append((doc_id, doc, packed, _packed(_runs(spans)), bool(single), contexts))
            if len(out) == 256:
                yield _batch(out, _OPENED)
                out = []
        if out:
            yield _batch(out, _OPENED)

    return run


def _batch(out: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*out, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _strings(data: bytes, offset: int, more: int, length: int) -> np.ndarray:
    """Hashes of the strings of an entry, each with its distance to the anchor."""
    starts = np.arange(more + 1)
    hashes = range_hashes(prefix_hashes(np.frombuffer(data, np.uint8)), starts, starts + length)
    return mix(hashes + (offset - starts).astype(np.uint64))


_SPANS = pa.schema([("doc", pa.int64()), ("begin", pa.int64()), ("end", pa.int64())])


def _found_spans(doc: int, place: int, repeated: np.ndarray, length: int) -> list[tuple[int, int, int]]:
    first, *_ = _unplaced(place)
    return [(doc, a, b) for a, b in _runs([(first + s, first + s + length) for s in np.flatnonzero(repeated).tolist()])]


def _compared(length: int):
    """Rows sorted by kfp: the strings of a class that are there twice, as spans."""

    def spans(members: list[tuple]) -> list[tuple[int, int, int]]:
        hashes = [_strings(data, *_unplaced(place)[1:], length) for _, place, _, data in members]
        values, inverse, counts = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
        twice = counts[inverse] > 1
        found, at = [], 0
        for (doc, place, asks, _), own in zip(members, hashes, strict=True):
            if asks:
                found += _found_spans(doc, place, twice[at : at + len(own)], length)
            at += len(own)
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, members, out = None, [], []
        for kfp, *member in rows(batches):
            if kfp != kind and members:
                out += spans(members) if len(members) > 1 else []
                members = []
                if len(out) > 5000:
                    yield _batch(out, _SPANS)
                    out = []
            kind = kfp
            members.append(tuple(member))
        if len(members) > 1:
            out += spans(members)
        if out:
            yield _batch(out, _SPANS)

    return run


def _string_rows(length: int):
    schema = pa.schema([("string", pa.int64()), ("doc", pa.int64()), ("begin", pa.int64()), ("asks", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, doc, place, asks, data in rows(batches):
            first, offset, more = _unplaced(place)
            hashes = _strings(data, offset, more, length)
            n = len(hashes)
            yield pa.RecordBatch.from_arrays(
                [_longs(hashes), pa.array(np.full(n, doc)), pa.array(first + np.arange(n)), pa.array([asks] * n)], schema=schema
            )

    return run


def _common_strings(contexts: DataFrame, length: int, class_rows: int) -> DataFrame:
    """(doc, begin, end) of bytes covered by strings that two compared entries share."""
    sizes = contexts.groupBy("kfp").count()
    large = sizes.where(F.col("count") > class_rows).select("kfp")
    small = contexts.join(large, "kfp", "left_anti").repartition("kfp").sortWithinPartitions("kfp")
    spans = small.select("kfp", "doc", "place", "asks", "bytes").mapInArrow(_compared(length), "doc long, begin long, end long")
    strings = (
        contexts.join(large, "kfp", "left_semi")
        .select("kfp", "doc", "place", "asks", "bytes")
        .mapInArrow(_string_rows(length), "string long, doc long, begin long, asks boolean")
    )
    twice = strings.groupBy("string").count().where("count > 1").select("string")
    apart = strings.where("asks").join(twice, "string", "left_semi")
    return spans.union(apart.select("doc", "begin", (F.col("begin") + length).alias("end")))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text without the removed spans, bytes before, bytes removed, spans)."""
    schema = pa.schema([
        ("doc_id", pa.int64()), ("kept", pa.binary()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
    ])
    out = []
    for doc_id, packed, removed, more in rows(batches):
        text = zlib.decompress(packed)
        spans = _runs(_unpacked(removed or b"") + [(s["begin"], s["end"]) for s in more or []])
        parts, at = [], 0
        for a, b in spans:
            parts.append(text[at:a])
            at = b
        parts.append(text[at:])
        out.append((doc_id, b"".join(parts), len(text), sum(b - a for a, b in spans), len(spans)))
        if len(out) == 256:
            yield _batch(out, schema)
            out = []
    if out:
        yield _batch(out, schema)


def without_repeats(
    docs: DataFrame, length: int = LENGTH, prefix: int = PREFIX, batches: int = BATCHES, class_rows: int = CLASS_ROWS
) -> DataFrame:
    """One row per row of ``docs``: doc_id, kept (bytes), n_bytes, n_removed, n_spans.

    Removed is every byte that a string of ``length`` bytes covers which also starts
    anywhere else in the texts as given, in the same document or another. NULL is an
    empty text. Texts shorter than ``length`` keep all. A row given twice repeats itself.
    Rows are told apart by a 64-bit hash of id and text; ids may be NULL. Other columns
    are not read; an empty table gives no rows.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", "text").alias("doc"), text.alias("text"))
    levels = SuffixLevels(spark)
    matches = []
    for number in range(batches):
        part = keyed.where(F.pmod("doc", F.lit(batches)) == number).select("text")
        matches.append(levels.add(part.mapInArrow(_counted(length, prefix), "kfp long, nfp long, n long")))
    verdicts = _verdicts(matches)

    entries = keyed.select("doc", "text").mapInArrow(_placed(length, prefix), "nfp long, doc long, place long")
    hits = staged(entries.join(verdicts, "nfp"), "suffix-hits")
    levels.close()
    shown = hits.where("state = 'mixed'").groupBy("nfp").agg(F.min(F.struct("doc", "place")).alias("s")).select("s.doc", "s.place")
    marked = hits.select("doc", "place", "state").union(shown.select("doc", "place", F.lit("shown")))
    in_state = lambda *states: F.collect_list(F.when(F.col("state").isin(*states), F.col("place")))
    per_doc = marked.groupBy("doc").agg(
        in_state("whole", "mixed").alias("whole"), in_state("single").alias("single"), in_state("shown").alias("shown")
    )
    packed = keyed.mapInArrow(_compressed, "doc_id long, doc long, packed binary")
    opened = staged(
        packed.join(per_doc, "doc", "left")
        .select("doc_id", "doc", "packed", "whole", "single", "shown")
        .mapInArrow(
            _opened(length, prefix),
            "doc_id long, doc long, packed binary, removed binary, open boolean,"
            " contexts array<struct<kfp:long,place:long,asks:boolean,bytes:binary>>",
        ),
        "suffix-opened",
    )
    contexts = opened.select("doc", F.explode("contexts").alias("c")).select("c.kfp", "doc", "c.place", "c.asks", "c.bytes")
    spans = _common_strings(contexts, length, class_rows)
    more = spans.groupBy("doc").agg(F.collect_set(F.struct("begin", "end")).alias("more"))
    settled = opened.where("NOT open").select("doc_id", "packed", "removed", F.lit(None).cast("array<struct<begin:long,end:long>>").alias("more"))
    rest = opened.where("open").join(more, "doc", "left").select("doc_id", "packed", "removed", "more")
    return settled.union(rest).mapInArrow(_cut, "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long")

