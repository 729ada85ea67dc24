"""Texts of an Arrow batch as one flat byte array, and their words as index arrays.

A null text is empty. Everything here works on a block of a batch, so memory is
bounded by the block size, or by the largest single text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 4 << 20

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

# ASCII other than letters and digits.
NOT_ALNUM = np.zeros(256, bool)
NOT_ALNUM[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_seeded = np.random.default_rng(20240229)
BYTE_VALUES = _seeded.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)


class Texts:
    """``data[offsets[i]:offsets[i + 1]]`` are the UTF-8 bytes of text i."""

    def __init__(self, column: pa.Array):
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        column = pc.fill_null(column, "").cast(pa.large_string())
        _, ends, data = column.buffers()
        n = len(column)
        if n:
            bounds = np.frombuffer(ends, np.int64)[column.offset : column.offset + n + 1]
        else:
            bounds = np.zeros(1, np.int64)
        raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
        self.data = raw[bounds[0] : bounds[-1]]
        self.offsets = bounds - bounds[0]

    def __len__(self) -> int:
        return len(self.offsets) - 1


def blocks(
    batches: Iterable[pa.RecordBatch], text: str, most: int = BLOCK_BYTES
) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Row ranges of the batches with about ``most`` bytes of text each, at least one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0), dtype=np.int64)
        ends = np.cumsum(sizes)
        first = 0
        while first < len(ends):
            before = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + most, "right")))
            part = batch.slice(first, last - first)
            yield part, Texts(part.column(text))
            first = last


def words(texts: Texts, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs without separators, and for each text the
    index of its first word (one more entry than texts)."""
    n = len(texts.data)
    if not n:
        empty = np.empty(0, np.int64)
        return empty, empty, np.zeros(len(texts) + 1, np.int64)
    inside = ~separator[texts.data]
    edge = np.zeros(n + 1, bool)
    edge[texts.offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:] | edge[1:-1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, texts.offsets)


def powers(n: int) -> np.ndarray:
    out = np.full(n, BASE, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def mixed(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values (a multiply and shift mix)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit polynomial hash of ``data[start:end]`` for each span; none may be empty."""
    if not len(starts):
        return np.empty(0, np.uint64)
    lengths = ends - starts
    scale = powers(int(lengths.max()))
    out = np.empty(len(starts), np.uint64)
    for first in range(0, len(starts), 1 << 15):  # arrays that stay in the cache
        own = lengths[first : first + (1 << 15)]
        heads = np.cumsum(own) - own
        within = np.arange(int(own.sum()), dtype=np.int64)
        source = within + np.repeat(starts[first : first + (1 << 15)] - heads, own)
        within -= np.repeat(heads, own)
        terms = BYTE_VALUES[data[source]]
        terms *= scale[within]
        out[first : first + (1 << 15)] = np.add.reduceat(terms, heads)
    return mixed(out + lengths.astype(np.uint64))


def ragged_take(values: np.ndarray, bounds: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows ``values[bounds[i]:bounds[i + 1]]`` for each i of ``index``, end to end, and
    where each begins (one more entry than ``index``)."""
    lengths = np.diff(bounds)[index]
    out = np.zeros(len(index) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    source = np.arange(out[-1], dtype=np.int64)
    source += np.repeat(bounds[:-1][index] - out[:-1], lengths)
    return values[source], out
