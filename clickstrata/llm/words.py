"""Words of many texts at once, as 64-bit hashes in numpy arrays.

Both word patterns of this subpackage split at ASCII characters only, so they
hold for UTF-8 bytes as well as for characters, and A-Z can be lower-cased
byte by byte. A word's hash is a polynomial over one random value per byte,
modulo 2^64, then mixed; words are told apart by these 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Texts are taken in slices of about this many bytes; the arrays over a slice are a few times as large.
SLICE_BYTES = 4 << 20
WINDOW_BYTES = 1 << 18
_BASE = 0x9E3779B97F4A7C15
_U = np.uint64

_fold = np.arange(256)
_fold[65:91] += 32
FOLD = _fold.astype(np.uint8)
_VALUES = np.random.default_rng(20240101).integers(1, 2**63, 256, dtype=np.uint64) | _U(1)


def _pattern(separators: Iterable[int]) -> np.ndarray:
    inside = np.ones(256, bool)
    inside[list(separators)] = False
    return inside


#: ``[^\x20\x09-\x0D]+``
NON_SPACE = _pattern([0x20, *range(0x09, 0x0E)])
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of text with A-Z lower-cased, so A-Z count as letters here.
ALPHANUMERIC = _pattern([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])


class _Powers:
    """Powers of the base and of its inverse, as far as they were asked for."""

    def __init__(self) -> None:
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, WINDOW_BYTES + 4096)
            self.up = self._row(_BASE, size)
            self.down = self._row(pow(_BASE, -1, 1 << 64), size)
        return self.up, self.down

    @staticmethod
    def _row(base: int, size: int) -> np.ndarray:
        row = np.full(size, base, np.uint64)
        row[0] = 1
        return np.multiply.accumulate(row)


_POWERS = _Powers()


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads all bits (the finaliser of splitmix64)."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


@dataclass
class Words:
    """Words of a slice of texts: hash, text number and byte place of each, and per text where its words begin."""

    hashes: np.ndarray
    texts: np.ndarray
    places: np.ndarray
    first: np.ndarray  # one more than there are texts

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def shingles(self, size: int) -> np.ndarray:
        """Hash of ``size`` consecutive words at each word; those that run over a text's end are meaningless."""
        n = len(self.hashes) - size + 1
        if n <= 0:
            return np.empty(0, np.uint64)
        out = np.full(n, size, np.uint64)
        for k in range(size):
            out = out * _U(0xD6E8FEB86659FD93) + self.hashes[k : k + n]
        return mix(out)

    def whole(self, size: int) -> np.ndarray:
        """Whether the ``size`` words from each word on are of one text."""
        n = len(self.hashes) - size + 1
        return self.texts[:n] == self.texts[size - 1 :] if n > 0 else np.empty(0, bool)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts (null: empty) and the offsets that cut them."""
    texts = pc.fill_null(texts, "")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    if not len(texts) or offsets is None:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.empty(0, np.uint8)
    return data, offsets - offsets[0]


def words_of(texts: pa.Array, pattern: np.ndarray) -> Words:
    data, offsets = text_bytes(texts)
    inside = pattern[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    begins[cuts] = inside[cuts]
    ends[cuts - 1] = inside[cuts - 1]
    begins, ends = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    hashes = np.empty(len(begins), np.uint64)
    values = _VALUES[FOLD]
    at = 0
    while at < len(begins):
        stop = max(at + 1, int(np.searchsorted(ends, begins[at] + WINDOW_BYTES)))
        low, high = begins[at], ends[stop - 1]
        up, down = _POWERS.upto(high - low + 1)
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(values[data[low:high]] * up[: high - low], out=sums[1:])
        left = begins[at:stop] - low
        hashes[at:stop] = (sums[ends[at:stop] - low] - sums[left]) * down[left]
        at = stop
    first = np.searchsorted(begins, offsets)
    return Words(mix(hashes), np.repeat(np.arange(len(offsets) - 1), np.diff(first)), begins, first)


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in pieces of about ``size`` text bytes, one row at least."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0)
        ends = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, before + size, side="right")))
            yield batch.slice(at, stop - at)
            at = stop
