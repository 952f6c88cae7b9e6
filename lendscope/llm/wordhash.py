"""Words of whole Arrow batches and their 64-bit hashes, with array operations only.

A word is a maximal run of bytes other than space and \\t..\\r (`[^\\x20\\x09-\\x0D]+`); in UTF-8
no other character holds those bytes. A word's hash is a polynomial in its bytes modulo
2**64, taken from running sums, and then mixed. Equal words have equal hashes in every
task; unequal ones collide with a chance of about 2**-64 for a pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Text bytes that are worked on at once; one longer text is one piece.
SLICE_BYTES = 1 << 20

_STEP = np.uint64(0x9E3779B97F4A7C15)
_ROOT = 0xD6E8FEB86659FD93
_ROOT_INVERSE = pow(_ROOT, -1, 1 << 64)
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_POWERS: list[np.ndarray] = []


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (splitmix64)."""
    x = values.astype(np.uint64)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(count: int) -> list[np.ndarray]:
    """At least ``count`` powers of the hash's base and of its inverse; the longest tables are kept."""
    if not _POWERS or len(_POWERS[0]) < count:
        size = 1 << max(16, int(count).bit_length())
        tables = np.full(size, _ROOT, np.uint64), np.full(size, _ROOT_INVERSE, np.uint64)
        for one in tables:
            one[0] = 1
        _POWERS[:] = [np.multiply.accumulate(one) for one in tables]
    return _POWERS


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One hash per span of ``values`` (bytes or code points), equal for equal spans wherever they lie."""
    base, back = powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    terms = values.astype(np.uint64)
    terms += np.uint64(1)
    terms *= base[: len(values)]
    np.cumsum(terms, out=sums[1:])
    return mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64) * _STEP)


@dataclass
class Words:
    """Words of a slice of documents; ``first`` has, for each document and one past, its first word."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    hashes: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def owner(self) -> np.ndarray:
        """The document of each word, as a place in the slice."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string column without nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    if not len(column):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], data[offsets[0] : offsets[-1]]


def slices(offsets: np.ndarray, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of documents of about ``size`` bytes; a longer document is a range of its own."""
    at, count = 0, len(offsets) - 1
    while at < count:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        yield at, end
        at = end


def words(offsets: np.ndarray, data: np.ndarray, lower: bool, blank: np.ndarray = _BLANK) -> Words:
    """The words of a slice whose texts lie one after the other in ``data``; ``blank`` tells the bytes between words."""
    if lower:
        data = _LOWER[data]
    length = len(data)
    solid = ~blank[data]
    # A text's end also ends its last word.
    edge = np.zeros(length + 1, bool)
    edge[offsets] = True
    begins = solid.copy()
    begins[1:] &= ~solid[:-1] | edge[1:length]
    stops = solid.copy()
    stops[:-1] &= ~solid[1:] | edge[1:length]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    first = np.searchsorted(starts, offsets)
    return Words(data, starts, ends, first, span_hashes(data, starts, ends))


def windows(hashes: np.ndarray, first: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(place of the first word, hash) of every run of ``length`` words inside one document."""
    total = len(hashes)
    if total < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    inside = np.ones(total - length + 1, bool)
    for back in range(1, length):  # a run may not cross the first word of a document
        crossing = first[:-1] - back
        crossing = crossing[(crossing >= 0) & (crossing < len(inside))]
        inside[crossing] = False
    # Documents without words share their first word with the next one: a run that starts there is fine.
    at = np.flatnonzero(inside)
    code = np.zeros(len(inside), np.uint64)
    for step in range(length):
        code = (code + hashes[step : step + len(inside)]) * np.uint64(_ROOT)
    return at, mix(code[at] ^ np.uint64(length))


def runs_of_lines(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lines, distinct lines) of each document of a slice; lines end at a line feed and empty ones don't count."""
    count = len(offsets) - 1
    feed = np.zeros(256, bool)
    feed[0x0A] = True
    found = words(offsets, data, lower=False, blank=feed)
    owner = found.owner
    order = np.lexsort((found.hashes, owner))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (owner[order][1:] != owner[order][:-1]) | (found.hashes[order][1:] != found.hashes[order][:-1])
    return found.counts, np.bincount(owner[order][fresh], minlength=count)
