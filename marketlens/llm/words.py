"""Words of many texts at once, as numbers: shared by the operators that work on word sequences."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# ASCII white space ends a word; letters are ASCII letters, digits, all above ASCII;
# A-Z fold to a-z.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LETTER = np.zeros(256, bool)
LETTER[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32

_random = np.random.Generator(np.random.PCG64(20240229))
BYTE = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ODD = _random.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
POWERS = 1 << 16
POWER = np.cumprod(np.full(POWERS, 0x9E3779B97F4A7C15 | 1, np.uint64))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, and where each begins and ends; null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str = "text", most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about `most` bytes of text; a longer text is a piece of its own."""
    if not batch.num_rows:
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    piece = (np.cumsum(lengths) - lengths) // most
    edges = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
    for begin, end in zip(edges, edges[1:]):
        yield batch.slice(begin, end - begin)


class Words:
    """Words of some texts: `begin` and `end` in `data`, `first` word of each text, and hashes."""

    def __init__(self, column: pa.Array, fold: bool = False, letters_only: bool = False):
        self.data, self.offsets = texts(column)
        inside = LETTER[self.data] if letters_only else ~SPACE[self.data]
        begin = inside.copy()
        begin[1:] &= ~inside[:-1]
        end = inside.copy()
        end[:-1] &= ~inside[1:]
        # Texts lie side by side: a word never goes over the edge of one.
        edges = self.offsets[1:-1]
        edges = edges[(edges > 0) & (edges < len(self.data))]
        begin[edges] = inside[edges]
        end[edges - 1] = inside[edges - 1]
        self.begin = np.flatnonzero(begin)
        self.end = np.flatnonzero(end) + 1
        self.first = np.searchsorted(self.begin, self.offsets)
        self.fold = fold
        self._hashes: np.ndarray | None = None

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self, most: int | None = None) -> np.ndarray:
        """64 bits of each word, or of its first `most` bytes, the same in all tasks."""
        if most is None and self._hashes is not None:
            return self._hashes
        if not len(self.begin):
            return np.empty(0, np.uint64)
        lengths = self.end - self.begin
        if most is not None:
            lengths = np.minimum(lengths, most)
        starts = np.cumsum(lengths) - lengths
        total = int(starts[-1] + lengths[-1])
        at = np.arange(total) - np.repeat(starts, lengths)
        raw = self.data[at + np.repeat(self.begin, lengths)]
        if self.fold:
            raw = FOLD[raw]
        sums = np.add.reduceat(BYTE[raw] * POWER[at & (POWERS - 1)], starts)
        found = mixed(sums + lengths.astype(np.uint64))
        if most is None:
            self._hashes = found
        return found


def windows(hashes: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """Hash of each run of `width` hashes; as many as fit into the whole array."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.full(n, np.uint64(width + 1000 * seed))
    for k in range(width):
        out += hashes[k : k + n] * ODD[(k + 7 * seed) % 64]
        if k % 8 == 7:
            out = mixed(out)
    return mixed(out)
