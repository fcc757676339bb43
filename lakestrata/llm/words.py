"""Words of whole text columns, as numpy arrays over one Arrow batch.

A word is a run of bytes other than space, tab, newline, vertical tab, form feed and carriage
return. Lower-casing touches A-Z only. A null text has no words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Texts are handled in pieces of about this many bytes; a longer text is a piece of its own.
PIECE_BYTES = 2 << 20

SPACES = np.zeros(256, dtype=bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
# Also every ASCII mark: only letters, digits and non-ASCII bytes make up a word.
MARKS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64: a bijection that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """Words of some documents. ``first[d] : first[d + 1]`` are those of document ``d``."""

    data: np.ndarray  # bytes of all texts
    offsets: np.ndarray  # of documents in data
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    letters: np.ndarray  # bytes of all words, one after another

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """64 bits per word; equal words have equal hashes on every machine."""
        if not len(self.starts):
            return np.empty(0, np.uint64)
        sizes = self.ends - self.starts
        at = np.cumsum(sizes) - sizes
        place = np.arange(len(self.letters)) - np.repeat(at, sizes)
        powers = np.full(int(sizes.max()), 0x9E3779B97F4A7C15, dtype=np.uint64)
        powers[0] = 1
        powers = np.cumprod(powers)
        sums = np.add.reduceat(_BYTE[self.letters] * powers[place], at)
        return mix(sums + sizes.astype(np.uint64))

    def document_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts())

    def word(self, n: int) -> bytes:
        return self.data[self.starts[n] : self.ends[n]].tobytes()


def words_of(column: pa.Array, lower: bool, between: np.ndarray = SPACES) -> Words:
    """``between`` marks the bytes that separate words."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    data = whole[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    if lower:
        data = _LOWER[data]
    space = between[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    before = np.concatenate(([True], space[:-1]))[: len(space)]
    after = np.concatenate((space[1:], [True]))[: len(space)]
    starts = np.flatnonzero(~space & (before | edge[:-1]))
    ends = np.flatnonzero(~space & (after | edge[1:])) + 1
    return Words(data, offsets, starts, ends, np.searchsorted(starts, offsets), data[~space])


def pieces(batch: pa.RecordBatch, column: str = "text", most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with about ``most`` bytes in ``column`` each."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column).cast(pa.large_binary())), 0)
    ends = np.cumsum(sizes.to_numpy())
    at = 0
    while at < batch.num_rows:
        base = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, base + most, side="right")))
        yield batch.slice(at, stop - at)
        at = stop


def runs(first: np.ndarray, width: int) -> np.ndarray:
    """Positions at which ``width`` consecutive words of one document start."""
    last = np.repeat(first[1:], np.diff(first))
    return np.flatnonzero(np.arange(len(last)) + width <= last)
