"""Packing documents into windows of tokens by non-negative least squares.

A document of four thousand tokens and more fills windows of its own. What is left of it,
or the whole of a shorter one, is a remainder, and has a class: its length in units,
rounded up. All shallow combinations of classes that fill a window are enumerated, and
non-negative least squares finds how often each is to be repeated so that the histogram of
the classes is used up. The counts are rounded, what they leave is combined greedily, class
by class, and the remainders no combination takes are laid end to end and cut at the windows'
ends. The very last, partial window becomes sequences of powers of two, which need no padding.

The driver sees the histogram only: one number per class, whatever the corpus. Remainders are
numbered inside their class by running totals over blocks, so a class that holds most
rows is never sorted in one task.
"""

from __future__ import annotations

import os
import string
import sys
import zlib
from array import array
from collections.abc import Iterator
from functools import partial
from types import ModuleType
from typing import NamedTuple
from unicodedata import is_normalized

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from billweave.llm.mixing import _block_starts
from billweave.staging import staged

WINDOW = 4096
#: Remainders are classed by their length in so many tokens, rounded up: at most this much
#: a piece, half of it on average, is padding.
UNIT = 16
#: So many remainders share a window that the least squares plan, or that the greedy step does.
DEPTH, GREEDY_DEPTH = 3, 6
#: Chunks of text a worker remembers the ids of, before it starts anew.
_REMEMBERED = 400_000
#: What the tokenizer takes for white space; no token crosses it.
_CONTROLS = "\x1c\x1d\x1e\x1f"  # fixed values: white space to Python, not to the tokenizer
#: The last Latin-1 letter: up to it a letter's lower case is one letter, wherever it stands.
_LATIN = "\xff"
#: ASCII marks; at the end of a word they are one token run of their own.
_MARKS = string.punctuation.replace("'", "")


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones for
    themselves, the others from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = (b for b in range(256) if b not in set(printable))
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Shelf(NamedTuple):
    """Windows filled by the same classes, largest first; ``repeats`` of them."""

    classes: tuple[int, ...]
    repeats: int


# --- the plan, from the histogram ------------------------------------------------------


def combinations(units: int, depth: int) -> list[tuple[int, ...]]:
    """All ways to write ``units`` as a sum of at most ``depth`` classes, largest first."""

    def parts(rest: int, most: int, left: int) -> Iterator[tuple[int, ...]]:
        if rest == 0:
            yield ()
        elif left:
            for first in range(min(rest, most), -(-rest // left) - 1, -1):
                for others in parts(rest - first, first, left - 1):
                    yield (first, *others)

    return list(parts(units, units, depth))


def nonnegative_least_squares(a: np.ndarray, b: np.ndarray, rounds: int = 3000) -> np.ndarray:
    """The x >= 0 with the least |a x - b|, by active sets: one column enters at a time, and
    columns that would turn negative leave."""
    x, active = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    slack = 1e-10 * max(1.0, float(np.abs(a.T @ b).max(initial=0.0)))
    for _ in range(rounds):
        gain = np.where(active, -np.inf, a.T @ (b - a[:, active] @ x[active]))
        if gain.max(initial=-np.inf) <= slack:
            break
        active[int(gain.argmax())] = True
        while True:
            chosen = np.flatnonzero(active)
            inner = a[:, chosen].T @ a[:, chosen]
            wanted = np.linalg.solve(inner + 1e-12 * np.eye(len(chosen)), a[:, chosen].T @ b)
            if wanted.min(initial=1.0) > 0:
                x[chosen] = wanted
                break
            falling = wanted <= 0
            before = x[chosen]
            step = float(np.min(before[falling] / np.maximum(before[falling] - wanted[falling], 1e-300)))
            moved = before + step * (wanted - before)
            leaves = falling & (moved <= 1e-12 * max(1.0, float(moved.max())))
            moved[leaves] = 0
            x[chosen] = moved
            if not leaves.any():  # rounding: nothing reached zero
                x[chosen[falling]] = 0
                leaves = falling
            active[chosen[leaves]] = False
    return x


def shelves(histogram: np.ndarray, depth: int = DEPTH, greedy_depth: int = GREEDY_DEPTH) -> list[Shelf]:
    """How often to fill a window in which way; ``histogram[c]`` counts the remainders of class c.

    ``histogram`` has one more entry than a window has units; entry 0 is not read. No shelf
    takes more of a class than there is, and every shelf is exactly full. What the list
    leaves is for the caller. An empty histogram gives no shelves.
    """
    units, left = len(histogram) - 1, np.array(histogram, np.int64)
    present = left > 0
    ways = [w for w in combinations(units, depth) if all(present[c] for c in w)]
    found: list[Shelf] = []

    def take(classes: tuple[int, ...], wanted: int) -> None:
        kinds, uses = np.unique(classes, return_counts=True)
        repeats = int(min(wanted, (left[kinds] // uses).min()))
        if repeats > 0:
            left[kinds] -= repeats * uses
            found.append(Shelf(classes, repeats))

    if ways:
        matrix = np.zeros((units + 1, len(ways)))
        for i, way in enumerate(ways):
            for c in way:
                matrix[c, i] += 1
        # Long remainders are harder to place: a class weighs as much as it has tokens.
        weight = np.arange(units + 1) / units
        scale = left[1:].sum()
        x = nonnegative_least_squares(matrix * weight[:, None], left * weight / scale) * scale
        for i in np.argsort(-x, kind="stable"):
            if x[i] < 0.5:
                break
            take(ways[i], int(x[i] + 0.5))
    # What rounding has left: the largest class, then at each step the largest that fits.
    for first in range(units, 0, -1):
        while left[first] > 0:
            room, classes, now = units, [], left.copy()
            while room and len(classes) < greedy_depth:
                fits = np.flatnonzero(now[1 : room + 1]) + 1
                if not len(fits):
                    break
                c = first if not classes else int(fits[-1])
                now[c] -= 1
                classes.append(c)
                room -= c
            if room:
                break
            take(tuple(classes), int(left[first]))
    return found


def slots(plan: list[Shelf], units: int) -> dict[int, np.ndarray]:
    """Per class its places in the plan: rows (first rank, first sequence, of the class in a
    window, places before it in the window), by rank; a last row ends the planned ranks."""
    rows: dict[int, list[tuple[int, int, int, int]]] = {c: [] for c in range(units + 1)}
    taken, sequence = [0] * (units + 1), 0
    for shelf in plan:
        for c in sorted(set(shelf.classes), reverse=True):
            uses, before = shelf.classes.count(c), shelf.classes.index(c)
            rows[c].append((taken[c], sequence, uses, before))
            taken[c] += uses * shelf.repeats
        sequence += shelf.repeats
    return {c: np.array([*rows[c], (taken[c], 0, 1, 0)], np.int64) for c in rows}


# --- inside tasks ----------------------------------------------------------------------


class Ids(dict):
    """Ids of chunks of text as little-endian 32-bit numbers, found when they are first asked for.

    No token crosses white space, so a text is looked up chunk by chunk.
    """

    def __init__(self, tokenizer: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_str(tokenizer)
        self.word, self.letters = self.tokenizer.model.tokenize, _byte_letters()

    def encoded(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def __missing__(self, chunk: str) -> bytes:
        # One word of Latin letters, and marks: all that the tokenizer does before it merges
        # is to lower-case the word and to part it from the marks.
        stem = chunk.rstrip(_MARKS)
        if not stem.isalpha() or not stem.isascii() and (max(stem) > _LATIN or not is_normalized("NFC", stem)):
            ids = self.encoded(chunk)
        elif len(stem) < len(chunk):
            ids = self[stem.lower()] + self[chunk[len(stem) :]]
        elif (low := stem.lower()) != stem:
            ids = self[low]
        else:
            letters = low if low.isascii() else low.encode().decode("latin-1").translate(self.letters)
            ids = array("I", [token.id for token in self.word(letters)]).tobytes()
        self[chunk] = ids
        return ids

    def of(self, text: str) -> bytes:
        if any(c in text for c in _CONTROLS):
            return self.encoded(text)
        if len(self) > _REMEMBERED:
            self.clear()
        return b"".join(map(self.__getitem__, text.split()))


def _worker_ids(tokenizer: str) -> Ids:
    """The ids a Python worker has learned, kept from task to task.

    Functions come to a task anew, so what is to last stands beside the worker's modules.
    """
    state = sys.modules.setdefault("billweave_packing_state", ModuleType("billweave_packing_state"))
    if getattr(state, "tokenizer", None) != tokenizer:
        state.tokenizer, state.ids = tokenizer, Ids(tokenizer)
    return state.ids


_TOKENS = "block int, number long, doc_id {id}, n long, class int, nth long, windows_before long, ids binary"


def _tokenised(
    batches: Iterator[pa.RecordBatch], tokenizer, end_id: int, window: int, unit: int, id_type: pa.DataType
) -> Iterator[pa.RecordBatch]:
    """Documents with their ids, their number in the task and in the task's rows of their class."""
    ids, end = _worker_ids(tokenizer.value), int(end_id).to_bytes(4, "little")
    block, number, windows = TaskContext.get().partitionId(), 0, 0
    seen: dict[int, int] = {}
    names = ["block", "number", "doc_id", "n", "class", "nth", "windows_before", "ids"]
    kinds = [pa.int32(), pa.int64(), id_type, pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            rows = []
            for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                found = ids.of(text or "") + end
                n = len(found) // 4
                kind = -(-(n % window) // unit)
                rows.append((block, number, doc_id, n, kind, seen.get(kind, 0), windows, found))
                seen[kind] = seen.get(kind, 0) + 1
                number, windows = number + 1, windows + n // window
            columns = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


class Line(NamedTuple):
    """Where the remainders outside the plan are cut: windows, then falling powers of two."""

    first: int  # its first sequence
    length: int
    window: int

    def pieces(self, at: int, length: int) -> Iterator[tuple[int, int, int]]:
        """(sequence, offset, length) of what lies at ``at``."""
        whole, rest = divmod(self.length, self.window)
        cuts = [whole * self.window]
        cuts += [cuts[0] + (rest >> b << b) for b in range(self.window.bit_length(), -1, -1) if rest >> b & 1]
        end = at + length
        while at < end:
            if at < cuts[0]:
                sequence, start = at // self.window, at // self.window * self.window
                stop = start + self.window
            else:
                k = next(i for i in range(1, len(cuts)) if at < cuts[i])
                sequence, start, stop = whole + k - 1, cuts[k - 1], cuts[k]
            stop = min(stop, end)
            yield self.first + sequence, at - start, stop - at
            at = stop


def _cut(
    batches: Iterator[pa.RecordBatch], line: Line, window: int, id_type: pa.DataType
) -> Iterator[pa.RecordBatch]:
    """Pieces of documents; columns doc_id, n, ids, first window, sequence, offset, line."""
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    kinds = [id_type, *[pa.int64()] * 6]
    for batch in batches:
        for i in range(0, batch.num_rows, 256):
            part, rows = batch.slice(i, 256), []
            columns = [part.column(k) for k in range(part.num_columns)]
            values = [c.to_pylist() for k, c in enumerate(columns) if k != 2]
            for j, (doc_id, n, first, sequence, offset, at) in enumerate(zip(*values, strict=True)):
                ids = memoryview(columns[2][j].as_buffer())
                whole, rest = divmod(n, window)
                found = [(first + k, 0, window) for k in range(whole)]
                if rest and at is None:
                    found.append((sequence, offset, rest))
                elif rest:
                    found += line.pieces(at, rest)
                start = 0
                for where, place, length in found:
                    crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
                    rows.append((doc_id, start, length, crc, n, where, place))
                    start += length
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names
            )


# --- the operator ----------------------------------------------------------------------


def _arrow_type(df: DataFrame, column: str) -> pa.DataType:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "smallint": pa.int16(), "tinyint": pa.int8(), "string": pa.string()}
    return kinds[dict(df.dtypes)[column]]


def tokens(docs: DataFrame, tokenizer_path: str, end_id: int = 2, window: int = WINDOW, unit: int = UNIT) -> DataFrame:
    """Every document with its ids (binary, 32 bits each), its block and number in the block.

    The tokenizer's file is read by the driver and sent to the tasks.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        tokenizer = docs.sparkSession.sparkContext.broadcast(file.read())
    kind = _arrow_type(docs, "doc_id")
    work = partial(_tokenised, tokenizer=tokenizer, end_id=end_id, window=window, unit=unit, id_type=kind)
    return docs.select("doc_id", "text").mapInArrow(work, _TOKENS.format(id=dict(docs.dtypes)["doc_id"]))


def _slot(places: dict[int, np.ndarray], base: int):
    """A column function of (class, rank): the sequence and the place in it, for planned ranks."""
    kind = StructType([StructField("sequence", LongType()), StructField("slot", IntegerType())])

    @F.pandas_udf(kind)
    def slot(classes: pd.Series, ranks: pd.Series) -> pd.DataFrame:
        found = np.zeros((len(classes), 2), np.int64)
        rank, of = ranks.to_numpy(), classes.to_numpy()
        for c in np.unique(of):
            here, rows = np.flatnonzero(of == c), places[int(c)]
            row = rows[np.searchsorted(rows[:, 0], rank[here], "right") - 1]
            turn, nth = np.divmod(rank[here] - row[:, 0], row[:, 2])
            found[here, 0], found[here, 1] = base + row[:, 1] + turn, row[:, 3] + nth
        return pd.DataFrame({"sequence": found[:, 0], "slot": found[:, 1].astype("int32")})

    return slot


def packed(
    docs: DataFrame, tokenizer_path: str, end_id: int = 2, window: int = WINDOW, unit: int = UNIT
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is the ids of its text and ``end_id``; NULL and empty texts are ``end_id``
    alone. Every row is a document, whether or not it repeats another or has no id. Each of
    its ids lies in one piece; pieces of a sequence follow each other without gaps from 0.
    Texts are read whole; a very long one fills windows of its own, then has one remainder.
    Sequences are ``window`` long at most (a power of two); their numbers have no gaps. An
    empty table gives no rows; other columns are not read.
    """
    if window & (window - 1) or window % unit:
        raise ValueError("a window is a power of two, and a multiple of the unit")
    kind = _arrow_type(docs, "doc_id")
    found = staged(tokens(docs, tokenizer_path, end_id, window, unit), "packing-ids")
    light = found.select("block", "number", "n", "class", "nth", "windows_before")
    counts = staged(
        light.groupBy("block", "class").agg(
            F.count(F.lit(1)).alias("docs"), F.sum(F.floor(F.col("n") / window)).alias("windows")
        ),
        "packing-counts",
    )
    units = window // unit
    histogram = np.zeros(units + 1, np.int64)
    windows = 0
    for row in counts.groupBy("class").agg(F.sum("docs").alias("docs"), F.sum("windows").alias("windows")).collect():
        histogram[row["class"]] = row["docs"]
        windows += row["windows"]
    plan = shelves(histogram)
    places = slots(plan, units)
    planned = F.array(*[F.lit(int(places[c][-1, 0])) for c in range(units + 1)])

    class_starts = _block_starts(counts.select("class", "block", "docs"), ["class"], "block", "docs")
    window_starts = _block_starts(counts.groupBy("block").agg(F.sum("windows").alias("windows")), [], "block", "windows")
    ranked = staged(
        light.join(class_starts.drop("docs"), ["block", "class"])
        .withColumn("rank", F.col("start") + F.col("nth")).drop("start")
        .join(window_starts.drop("windows"), "block")
        .select(
            "block", "number", "class", "rank", (F.col("n") % window).alias("rest"),
            (F.col("start") + F.col("windows_before")).alias("first"),
            (F.col("rank") < F.get(planned, F.col("class"))).alias("planned"),
        ),
        "packing-ranks",
    )
    shelf = Window.partitionBy("sequence").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    slot = _slot(places, windows)
    on_shelves = (
        ranked.where("planned").withColumn("_s", slot("class", "rank")).select("*", "_s.*")
        .withColumn("offset", F.coalesce(F.sum("rest").over(shelf), F.lit(0)))
    )
    loose = ranked.where("NOT planned")
    sums = loose.groupBy("block").agg(F.sum("rest").alias("rests"))
    inside = Window.partitionBy("block").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    on_line = loose.join(_block_starts(sums, [], "block", "rests").drop("rests"), "block").withColumn(
        "line", F.col("start") + F.coalesce(F.sum("rest").over(inside), F.lit(0))
    )
    length = loose.agg(F.sum("rest")).first()[0] or 0
    line = Line(windows + sum(s.repeats for s in plan), length, window)
    none = F.lit(None).cast("long")
    where = on_shelves.select("block", "number", "first", "sequence", "offset", none.alias("line")).union(
        on_line.select("block", "number", "first", none.alias("sequence"), none.alias("offset"), "line")
    )
    return (
        found.select("block", "number", "doc_id", "n", "ids")
        .join(where, ["block", "number"])
        .select("doc_id", "n", "ids", "first", "sequence", "offset", "line")
        .mapInArrow(
            partial(_cut, line=line, window=window, id_type=kind),
            f"doc_id {dict(docs.dtypes)['doc_id']}, start long, length long, ids_crc32 long,"
            " doc_tokens long, sequence_id long, offset long",
        )
    )
