"""Document quality from lines, by a linear-chain conditional random field.

Every line is good or bad. A line's score comes from the characters and words of the line
and of its two neighbours; a matrix scores the change from line to line. The marginals
of the forward-backward algorithm, weighted by the lines' lengths, make the document's
score. The field is fitted on a bounded sample of labelled documents, all lines of a
document bearing its label, and then scores all documents in one pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billweave.llm.shingles import prefix_hashes, range_hashes, rows

#: So many labelled documents are fitted on, at most.
SAMPLE_DOCS = 3000
ROUNDS = 150
RATE = 0.1
#: Squares of weights, and of the change matrix, are charged so much per document.
CHARGE, CHANGE_CHARGE = 1e-3, 3e-2

_LETTER, _CAPITAL, _DIGIT, _SYMBOL, _BANG, _POINT, _SPACE, _OTHER = range(8)
_KIND = np.full(256, _OTHER, np.int64)
for _kind, _bytes in (
    (_LETTER, [*range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]),
    (_CAPITAL, range(ord("A"), ord("Z") + 1)),
    (_DIGIT, range(ord("0"), ord("9") + 1)),
    (_SYMBOL, b"#*$%&|<>"),
    (_BANG, b"!?"),
    (_POINT, b".,;:"),
    (_SPACE, b" \t\n\r\x0b\x0c"),
):
    _KIND[list(_bytes)] = _kind
OWN = 12
FEATURES = 3 * OWN + 1


def line_features(text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """(lines, OWN) features, and the lines' lengths in bytes; None is one empty line."""
    data = np.frombuffer(text or b"", np.uint8)
    breaks = np.flatnonzero(data == 10)
    starts, ends = np.concatenate([[0], breaks + 1]), np.concatenate([breaks, [len(data)]])
    lengths, n = ends - starts, len(starts)
    line = np.repeat(np.arange(n), lengths + 1)[: len(data)]
    counts = np.bincount(line * 8 + _KIND[data], minlength=8 * n).reshape(n, 8).astype(float)

    inside = np.concatenate([[False], _KIND[data] != _SPACE, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    first, behind = edges[::2], edges[1::2]
    sums = prefix_hashes(data)
    word, word_line = range_hashes(sums, first, behind), line[first] if len(first) else np.empty(0, int)
    words = np.bincount(word_line, minlength=n).astype(float)
    again = (word[1:] == word[:-1]) & (word_line[1:] == word_line[:-1])
    same = np.bincount(word_line[1:][again], minlength=n)
    pairs = np.unique(np.stack([word_line.astype(np.uint64), word]), axis=1)[0] if len(word) else np.empty(0, np.uint64)
    distinct = np.bincount(pairs.astype(np.int64), minlength=n)

    whole = range_hashes(sums, starts, ends)
    _, at = np.unique(whole, return_index=True)
    repeated = np.ones(n)
    repeated[at] = 0
    letters = np.maximum(counts[:, _LETTER] + counts[:, _CAPITAL], 1)
    some, bytes_ = np.maximum(words, 1), np.maximum(lengths, 1)
    own = np.stack([
        np.log1p(lengths) / 8,
        counts[:, _CAPITAL] / letters,
        counts[:, _DIGIT] / bytes_,
        np.minimum(counts[:, _SYMBOL] / some, 3),
        np.minimum(counts[:, _BANG] / some, 3),
        np.minimum(counts[:, _POINT] / some, 1),
        np.minimum(counts[:, _OTHER] / bytes_, 1),
        np.minimum(lengths / some / 10, 3),
        same / some,
        distinct / some,
        repeated * (words > 0),
        (words < 3).astype(float),
    ], axis=1)
    return own, lengths


def with_neighbours(own: np.ndarray) -> np.ndarray:
    """Own, last and next line's features, and a one; outside the text all are 0."""
    none = np.zeros((1, OWN))
    return np.concatenate(
        [own, np.concatenate([none, own[:-1]]), np.concatenate([own[1:], none]), np.ones((len(own), 1))], axis=1
    )


@dataclass
class Field:
    weights: np.ndarray
    change: np.ndarray

    def marginals(self, scores: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """P(good) of every line, and the expected number of each change.

        ``scores`` are the lines of all texts in a row, ``lengths`` their numbers. A step
        advances all texts that are long enough.
        """
        order = np.argsort(-lengths, kind="stable")
        starts, sizes = (np.cumsum(lengths) - lengths)[order], lengths[order]
        active = [int(np.searchsorted(-sizes, -t, side="left")) for t in range(int(sizes[0]) if len(sizes) else 0)]
        ahead, back = np.zeros((len(scores), 2)), np.zeros((len(scores), 2))
        emit = np.stack([np.zeros(len(scores)), scores], axis=1)
        c = self.change
        step = lambda v, m: np.logaddexp(v[:, :1] + m[0], v[:, 1:] + m[1])
        for t, n in enumerate(active):
            at = starts[:n] + t
            ahead[at] = emit[at] + (step(ahead[at - 1], c) if t else 0)
            ahead[at] -= ahead[at].max(axis=1, keepdims=True)
        for t in range(len(active) - 2, -1, -1):
            at = starts[: active[t + 1]] + t
            back[at] = step(back[at + 1] + emit[at + 1], c.T)
            back[at] -= back[at].max(axis=1, keepdims=True)
        both = ahead + back
        good = 1 / (1 + np.exp(np.clip(both[:, 0] - both[:, 1], -700, 700)))
        inner = np.ones(len(scores), bool)
        inner[starts[sizes > 0]] = False
        at = np.flatnonzero(inner)
        pair = ahead[at - 1][:, :, None] + c + (emit[at] + back[at])[:, None, :]
        pair = np.exp(pair - pair.max(axis=(1, 2), keepdims=True))
        changes = (pair / pair.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        return good, changes


def fit(texts: list[np.ndarray], labels: list[int]) -> Field:
    """Maximum likelihood of the labels with a charge on squares, by Adam steps."""
    field = Field(np.zeros(FEATURES), np.zeros((2, 2)))
    if not texts:
        return field
    lengths = np.array([len(x) for x in texts])
    inputs = np.concatenate([with_neighbours(x) for x in texts])
    truth = np.repeat(np.array(labels, float), lengths)
    seen = np.zeros((2, 2))
    for n, label in zip(lengths, labels, strict=True):
        seen[label, label] += n - 1
    value = np.concatenate([field.weights, field.change.ravel()])
    m, v = np.zeros_like(value), np.zeros_like(value)
    charge = np.concatenate([np.full(FEATURES, CHARGE), np.full(4, CHANGE_CHARGE)])
    for step in range(1, ROUNDS + 1):
        field = Field(value[:FEATURES], value[FEATURES:].reshape(2, 2))
        good, changes = field.marginals(inputs @ field.weights, lengths)
        slope = np.concatenate([inputs.T @ (truth - good), (seen - changes).ravel()]) / len(texts) - charge * value
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope**2
        value = value + RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Field(value[:FEATURES], value[FEATURES:].reshape(2, 2))


def document_scores(field: Field, texts: list[bytes | None]) -> np.ndarray:
    """Mean P(good) of the lines by length; a text of empty lines takes their plain mean."""
    made = [line_features(text) for text in texts]
    counts = np.array([len(own) for own, _ in made])
    scores = np.concatenate([with_neighbours(own) @ field.weights for own, _ in made])
    good, _ = field.marginals(scores, counts)
    weight = np.concatenate([n if n.any() else np.ones(len(n)) for _, n in made]).astype(float)
    at = np.cumsum(counts) - counts
    return np.clip(np.add.reduceat(good * weight, at) / np.add.reduceat(weight, at), 0, 1)


def remainder(doc_id: str = "doc_id"):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5


def _sampled(docs: DataFrame, labels: DataFrame) -> tuple[list[np.ndarray], list[int]]:
    """Line features and labels of the sample: the least hashes among labelled rows."""
    chosen = (
        labels.where(F.col("quality").isin(0, 1) & (remainder() != 0))
        .select(F.col("doc_id").alias("_id"), F.col("quality").cast("int").alias("_label"))
        .orderBy(F.xxhash64("_id"), "_id", "_label")
        .limit(SAMPLE_DOCS)
    )
    found = docs.select("doc_id", F.col("text").cast("binary").alias("text")).join(
        chosen, F.col("doc_id") == F.col("_id")
    )

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(i, label, line_features(text)[0].astype(np.float32).tobytes()) for i, text, label in rows(iter([batch]))]
            columns = list(zip(*out, strict=True)) or [()] * 3
            kinds = [pa.int64(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["id", "label", "lines"]
            )

    sample = (
        found.select(F.col("doc_id").cast("long"), "text", "_label")
        .mapInArrow(described, "id long, label int, lines binary")
        .collect()
    )
    sample.sort(key=lambda r: (r["id"], r["label"], bytes(r["lines"])))
    texts = [np.frombuffer(bytes(r["lines"]), np.float32).reshape(-1, OWN).astype(float) for r in sample]
    return texts, [r["label"] for r in sample]


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    Labels are learned from rows of ``labels`` only whose crc32(doc_id) mod 5 is not 0,
    at most ``SAMPLE_DOCS`` of them; NULL or other labels are left out. Without labels
    all scores are 0.5. Only texts are scored: an empty or NULL text is one empty line.
    Repeated rows get equal scores. A row without doc_id counts as held out. Columns
    beyond doc_id and text are not read.
    """
    field = fit(*_sampled(docs, labels))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 128):
                part = batch.slice(i, 128)
                scores = document_scores(field, part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores)], ["doc_id", "score"])

    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return found.mapInArrow(scored, "doc_id long, score double").select(
        "doc_id",
        F.coalesce(remainder() == 0, F.lit(True)).alias("held_out"),
        "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"),
    )
