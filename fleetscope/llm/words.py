"""Words of whole texts as numpy arrays, for the operators that run in tasks.

A word is a maximal run of ``[^\\x20\\x09-\\x0D]``. Splitting and hashing are
vectorised over a slice of an Arrow batch, so memory follows the slice and, for
a single long text, that text. Hashes are 64 bits and the same in every process.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C13)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_WORD_BASE = np.uint64(0xD6E8FEB86659FD93)
_WORD_INVERSE = np.uint64(pow(int(_WORD_BASE), -1, 1 << 64))

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTES = np.random.Generator(np.random.PCG64(20)).integers(1, 1 << 63, 256, dtype=np.uint64)
_LOWERED = _BYTES.copy()
_LOWERED[65:91] = _BYTES[97:123]

_powers: dict[np.uint64, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits; a bijection."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def xxhash64(*columns: np.ndarray) -> np.ndarray:
    """Spark's ``xxhash64`` of columns of 64-bit values."""
    one, two, three, four, five = (
        np.uint64(x)
        for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
    )
    found = np.full(len(columns[0]), 42, dtype=np.uint64)
    for x in columns:
        x = x * two
        found = (found + five + np.uint64(8)) ^ (((x << np.uint64(31)) | (x >> np.uint64(33))) * one)
        found = ((found << np.uint64(27)) | (found >> np.uint64(37))) * one + four
        found = (found ^ (found >> np.uint64(33))) * two
        found = (found ^ (found >> np.uint64(29))) * three
        found = found ^ (found >> np.uint64(32))
    return found


def _power(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        size = max(n, 1 << 16)
        known = np.empty(size, dtype=np.uint64)
        known[0] = 1
        known[1:] = base
        np.multiply.accumulate(known, out=known)
        if size <= 4 * SLICE_BYTES:  # an exceptionally long text's table isn't kept
            _powers[base] = known
    return known[:n]


def _range_hash(values, starts, ends, base, inverse) -> np.ndarray:
    """Polynomial hashes of values[start:end], by differences of one prefix sum."""
    if not len(starts):
        return np.empty(0, dtype=np.uint64)
    sums = np.empty(len(values) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum(values * _power(base, len(values)), out=sums[1:])
    ranged = (sums[ends] - sums[starts]) * _power(inverse, len(values))[starts]
    return mix(ranged + (ends - starts).astype(np.uint64))


@dataclass(frozen=True)
class Words:
    """Words of several texts: bytes, word bounds in them, and the bounds of
    each text's words (text ``i`` has the words ``first[i]:first[i + 1]``)."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    text_starts: np.ndarray

    @property
    def texts(self) -> int:
        return len(self.first) - 1

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.texts), self.counts)

    def hashes(self, lower: bool = False) -> np.ndarray:
        table = _LOWERED if lower else _BYTES
        return _range_hash(table[self.data], self.starts, self.ends, _BASE, _INVERSE)


def split_words(texts: pa.Array) -> Words:
    """The words of an Arrow string array; a null text has none."""
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1]
    low, high = int(offsets[0]), int(offsets[-1])
    buffer = texts.buffers()[2]
    if buffer is None or high == low:
        empty = np.empty(0, dtype=np.int64)
        none = np.zeros(len(texts) + 1, dtype=np.int64)
        return Words(np.empty(0, dtype=np.uint8), empty, empty, none, none)
    data = np.frombuffer(buffer, dtype=np.uint8)[low:high]
    bounds = offsets - low
    inside = ~_SPACE[data]
    at_start = inside.copy()
    at_start[1:] &= ~inside[:-1]
    cuts = bounds[:-1][bounds[:-1] < len(data)]
    at_start[cuts] = inside[cuts]
    at_end = inside.copy()
    at_end[:-1] &= ~inside[1:]
    cuts = bounds[1:][bounds[1:] > 0] - 1
    at_end[cuts] = inside[cuts]
    starts = np.flatnonzero(at_start)
    ends = np.flatnonzero(at_end) + 1
    return Words(data, starts, ends, np.searchsorted(starts, bounds), bounds)


_LETTERS = np.zeros(256, dtype=bool)
_LETTERS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def bare_words(found: Words) -> Words:
    """The words without ASCII punctuation and signs; what has nothing else is
    no word here."""
    letters = _LETTERS[found.data]
    kept = np.append(0, np.cumsum(letters))
    starts, ends = kept[found.starts], kept[found.ends]
    some = ends > starts
    before = np.append(0, np.cumsum(some))
    return Words(
        found.data[letters], starts[some], ends[some], before[found.first], kept[found.text_starts]
    )


def latin_capitals(data: np.ndarray) -> np.ndarray:
    """Second bytes of the capitals of Latin-1; adding 0x20 makes them small."""
    return np.append(False, data[:-1] == 0xC3)[: len(data)] & (data >= 0x80) & (data <= 0x9E)


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of every ``size`` consecutive values, over text bounds as well:
    the caller keeps those that lie inside one text."""
    if len(hashes) < size:
        return np.empty(0, dtype=np.uint64)
    starts = np.arange(len(hashes) - size + 1)
    return _range_hash(hashes, starts, starts + size, _WORD_BASE, _WORD_INVERSE)


def inner_windows(first: np.ndarray, size: int) -> np.ndarray:
    """Starts of the windows of ``size`` words that lie inside one text."""
    counts = np.maximum(np.diff(first) - size + 1, 0)
    return ranges(first[:-1], counts)


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of the given lengths, one after another."""
    total = int(counts.sum())
    if not total:
        return np.empty(0, dtype=np.int64)
    before = np.cumsum(counts) - counts
    return np.arange(total) - np.repeat(before - starts, counts)


def slices(
    batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows whose texts hold about ``limit`` bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(text).cast(pa.large_string())
        offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)
        offsets = offsets[column.offset : column.offset + len(column) + 1]
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
            to = min(max(to, at + 1), batch.num_rows)
            yield batch.slice(at, to - at)
            at = to


def signed(x: np.ndarray) -> np.ndarray:
    """64-bit hashes as Spark's bigint."""
    return x.view(np.int64)


def packed(values: np.ndarray) -> bytes:
    """Whole numbers from 0 on in as many bytes as the largest needs, lowest bytes
    of all first, after a byte that holds this width."""
    values = np.ascontiguousarray(values).view(np.uint64)
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    return bytes([width]) + values.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, dtype=np.uint8, offset=1).reshape(data[0], -1)
    values = np.zeros((planes.shape[1], 8), dtype=np.uint8)
    values[:, : data[0]] = planes.T
    return values.view(np.uint64).ravel()
