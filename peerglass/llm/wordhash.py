"""Words, lines and shingles of many texts at once, as numpy arrays.

Texts are UTF-8 bytes in one buffer.  Every piece gets a 64-bit hash: the sum of its bytes times fixed random
multipliers by place.  Two different pieces agree with a probability of about 2^-57.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def scramble(values: np.ndarray) -> np.ndarray:
    """A fixed one-to-one mixing of 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = values.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class _Multipliers:
    """Random multipliers by place, as many as the longest piece so far needs."""

    def __init__(self) -> None:
        self.values = scramble(np.arange(1 << 12)) | np.uint64(1)

    def upto(self, size: int) -> np.ndarray:
        if size > len(self.values):
            self.values = scramble(np.arange(2 * size)) | np.uint64(1)
        return self.values


_PLACES = _Multipliers()


def pieces_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the non-empty pieces [start, end) of the buffer; they must not overlap and must be in order."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    sizes = ends - starts
    firsts = np.cumsum(sizes) - sizes
    total = int(sizes.sum())
    place = np.arange(total) - np.repeat(firsts, sizes)
    picked = data[np.arange(total) + np.repeat(starts - firsts, sizes)] if total != len(data) else data
    with np.errstate(over="ignore"):
        weighted = _PLACES.upto(int(sizes.max()))[place] * (picked.astype(np.uint64) + np.uint64(1))
        return scramble(np.add.reduceat(weighted, firsts))


class Texts:
    """Words of some texts: for each word its text, start, end and hash."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, lower: bool) -> None:
        self.data, self.bounds, self.count = data, bounds, len(bounds) - 1
        solid = ~_SPACE[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[bounds] = True
        before = np.concatenate([[False], solid[:-1]]) if len(data) else solid
        after = np.concatenate([solid[1:], [False]]) if len(data) else solid
        self.solid = solid
        self.starts = np.flatnonzero(solid & (~before | edge[:-1]))
        self.ends = np.flatnonzero(solid & (~after | edge[1:])) + 1
        self.doc = np.searchsorted(bounds, self.starts, side="right") - 1
        self.words = np.bincount(self.doc, minlength=self.count)
        self.hash = pieces_hash(_LOWER[data] if lower else data, self.starts, self.ends)

    def grams(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(place of the first word, hash) of all runs of ``size`` words that stay in their text."""
        count = len(self.hash) - size + 1
        if count <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        inside = np.flatnonzero(self.doc[:count] == self.doc[size - 1:])
        with np.errstate(over="ignore"):
            total = np.zeros(len(inside), np.uint64)
            for n, factor in enumerate(scramble(np.arange(1000, 1000 + size)) | np.uint64(1)):
                total += self.hash[inside + n] * factor
        return inside, scramble(total)

    def per_text(self, mask: np.ndarray) -> np.ndarray:
        """How many bytes of each text are marked."""
        running = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return running[self.bounds[1:]] - running[self.bounds[:-1]]


def chunks(column: pa.Array, size: int = 1 << 19) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, one past the last, bytes, bounds) of pieces of a text column of about ``size`` bytes; null is empty."""
    column = column.cast(pa.large_binary())
    lengths = np.array(pc.fill_null(pc.binary_length(column), 0), np.int64)
    first, rows = 0, len(column)
    running = np.cumsum(lengths)
    while first < rows:
        past = int(np.searchsorted(running, (running[first - 1] if first else 0) + size, side="right"))
        past = min(max(past, first + 1), rows)
        data = b"".join(v for v in column.slice(first, past - first).to_pylist() if v)
        yield first, past, np.frombuffer(data, np.uint8), np.concatenate([[0], np.cumsum(lengths[first:past])])
        first = past
