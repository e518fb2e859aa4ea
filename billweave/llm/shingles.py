"""Word shingles of UTF-8 texts as sorted 64-bit hashes, and universal hash minima.

These run inside Spark tasks, on one text at a time; memory follows the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SHINGLE = 5
_MASK = (1 << 64) - 1
#: An odd factor; texts are polynomials in it, modulo 2^64.
_FACTOR = 0x9E3779B97F4A7C15
_TABLE = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[str, np.ndarray] = {}


def _power(name: str, factor: int, length: int) -> np.ndarray:
    """1, factor, factor^2, ...; grown by doubling."""
    known = _powers.get(name)
    if known is None:
        known = np.ones(1, np.uint64)
    while len(known) < length:
        known = np.concatenate([known, known * np.uint64(pow(factor, len(known), 1 << 64))])
    _powers[name] = known
    return known[:length]


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit values over all of them."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Sums of the polynomial's terms before each byte, and behind the last."""
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_TABLE[data] * _power("up", _FACTOR, len(data)), out=sums[1:])
    return sums


def range_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the byte ranges; equal ranges have equal hashes wherever they stand."""
    down = _power("down", pow(_FACTOR, -1, 1 << 64), len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def window_ranks(sums: np.ndarray, width: int) -> np.ndarray:
    """A number for every window of ``width`` bytes, equal for equal bytes, in no order."""
    down = _power("down", pow(_FACTOR, -1, 1 << 64), len(sums) - width)
    return (sums[width:] - sums[:-width]) * down * np.uint64(0xD6E8FEB86659FD93)


def sequence(text: bytes | None) -> np.ndarray:
    """Hashes of all five-word shingles in the order of the text, A-Z lower-cased.

    Words are parted by ASCII white space. A text with fewer words is one shingle; a text
    without words, or None, has none.
    """
    if not text:
        return np.empty(0, np.uint64)
    found = text.lower().split()
    if not found:
        return np.empty(0, np.uint64)
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    sums = prefix_hashes(np.frombuffer(b" ".join(found), np.uint8))
    last = min(SHINGLE, len(found)) - 1
    return range_hashes(sums, starts[: len(found) - last], ends[last:])


def shingle_set(text: bytes | None) -> np.ndarray:
    """The distinct shingles, sorted."""
    return np.unique(sequence(text))


def shared(a: np.ndarray, b: np.ndarray) -> int:
    """How many values two sorted sets have in common."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    return int(np.count_nonzero(b[np.minimum(at, len(b) - 1)] == a))


class Minima:
    """``count`` hash functions x -> a x + b modulo 2^64; their minima over shingles."""

    _CHUNK = 512

    def __init__(self, count: int, seed: int) -> None:
        rng = np.random.default_rng(seed)
        self.a = (rng.integers(1, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1))[:, None]
        self.b = rng.integers(0, 1 << 63, count, dtype=np.uint64)[:, None]

    def of(self, shingles: np.ndarray) -> np.ndarray:
        """One minimum per function; there has to be a shingle."""
        least = None
        for i in range(0, len(shingles), self._CHUNK):
            here = (self.a * shingles[None, i : i + self._CHUNK] + self.b).min(axis=1)
            least = here if least is None else np.minimum(least, here)
        return least

    def of_blocks(self, shingles: np.ndarray, block: int) -> np.ndarray:
        """Minima over consecutive blocks of the sequence, as (functions, blocks)."""
        parts = []
        step = max(1, self._CHUNK // block) * block
        for i in range(0, len(shingles), step):
            chunk = shingles[i : i + step]
            hashed = self.a * chunk[None, :] + self.b
            parts.append(np.minimum.reduceat(hashed, np.arange(0, len(chunk), block), axis=1))
        return np.concatenate(parts, axis=1)


def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows of Arrow batches as tuples of Python values, a slice of a batch at a time."""
    for batch in batches:
        for i in range(0, batch.num_rows, 256):
            part = batch.slice(i, 256)
            yield from zip(*[part.column(k).to_pylist() for k in range(part.num_columns)], strict=True)
