"""Words of Arrow text columns as numpy arrays.

A word is a run of bytes other than space and 0x09-0x0D; A-Z are lower-cased.  A batch is
handled as one byte array: word hashes come from prefix sums, so no Python loop runs over
words.  Equal words have equal 64-bit hashes in every process.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 19  # of text handled at once, with about 64 bytes of arrays a byte; a longer text is a chunk of its own
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
BYTE_VALUES = np.random.default_rng(20240501).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit scrambler."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_tables: dict[int, np.ndarray] = {}


def _power_table(base: int, n: int) -> np.ndarray:
    """The first n powers of base; the longest table so far is kept."""
    table = _tables.get(base)
    if table is None or len(table) < n:
        table = np.full(1 << max(16, (n - 1).bit_length()), base, np.uint64)
        table[0] = 1
        table = _tables[base] = np.multiply.accumulate(table)
    return table[:n]


@dataclass
class Words:
    """Words of some texts: byte range in ``data`` (lower-cased), hash, and the first word
    of each text (``first`` has one entry more than there are texts)."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray

    @property
    def text_of(self) -> np.ndarray:
        """Index of each word's text."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def words_of(texts: pa.Array) -> Words:
    """Words of a string array; nulls count as empty."""
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    n = int(offsets[-1] - offsets[0])
    if n == 0:
        none = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint8), none, none, np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64))
    raw = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    data = LOWER[raw]
    inside = ~SPACE[raw]
    cut = np.zeros(n + 1, bool)  # a text begins here
    cut[offsets] = True
    before = np.empty(n, bool)
    before[0], before[1:] = False, inside[:-1]
    start = np.flatnonzero(inside & (~before | cut[:n]))
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, inside[1:]
    end = np.flatnonzero(inside & (~after | cut[1:])) + 1
    sums = np.zeros(n + 1, np.uint64)
    values = BYTE_VALUES[data]
    values *= _power_table(BASE, n)
    np.cumsum(values, out=sums[1:])
    del values
    inverse = pow(BASE, -1, 1 << 64)
    hashes = mix((sums[end] - sums[start]) * _power_table(inverse, n)[start] + (end - start).astype(np.uint64))
    return Words(data, start, end, hashes, np.searchsorted(start, offsets))


def chunks(
    batches: Iterator[pa.RecordBatch], column: str = "text", chunk_bytes: int = CHUNK_BYTES
) -> Iterator[tuple[pa.RecordBatch, Words]]:
    """Slices of the batches with about ``chunk_bytes`` of text, and their words."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        total, begin = 0, 0
        for i, size in enumerate(lengths):
            if i > begin and total + size > chunk_bytes:
                piece = batch.slice(begin, i - begin)
                yield piece, words_of(piece.column(column))
                total, begin = 0, i
            total += size
        if begin < len(lengths):
            piece = batch.slice(begin)
            yield piece, words_of(piece.column(column))
