"""Words and hashes of many texts at once, as numpy arrays over the bytes of an Arrow column."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes looked at together; bounds the working arrays (about 50 bytes of memory for each).
BLOCK = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_BYTE_VALUES = np.random.Generator(np.random.PCG64(20240611)).integers(1, 2**63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit values (a bijection, so equal results mean equal values)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def place_keys(n: int) -> np.ndarray:
    """An odd random number for each place in a word: no powers, so that no pattern of letters sums up to nothing."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_BASE)) | np.uint64(1)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column, one text after the other, and where each begins (one more entry for the end)."""
    column = pc.fill_null(column, "" if not pa.types.is_binary(column.type) else b"").cast(pa.large_string())
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[starts[0] : starts[-1]], starts - starts[0]


def words(data: np.ndarray, starts: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word (maximal run without ASCII white space) and, per text, where its words begin.

    A-Z count as a-z with ``lower``. A word's hash depends on its bytes alone.
    """
    hashes, counts = [], np.zeros(len(starts), np.int64)
    for first, last in _blocks(data, starts):
        part = data[first:last]
        low = _LOWER[part] if lower else part
        gap = _SPACE[part]
        before = np.empty(len(part), bool)
        before[0] = True
        before[1:] = gap[:-1]
        inside = starts[np.searchsorted(starts, first, "left") : np.searchsorted(starts, last, "left")] - first
        before[inside] = True
        begin = np.flatnonzero(before & ~gap)
        if not len(begin):
            continue
        low, gap = low[begin[0] :], gap[begin[0] :]
        first, begin = first + int(begin[0]), begin - begin[0]
        place = np.arange(len(low), dtype=np.int64) - np.repeat(begin, np.diff(begin, append=len(low)))
        place[gap] = 0
        values = _BYTE_VALUES[low]
        values *= place_keys(int(place.max()) + 1)[place]
        values[gap] = 0
        hashes.append(mix(np.add.reduceat(values, begin)))
        text = np.searchsorted(starts, begin + first, "right") - 1
        counts[: len(starts) - 1] += np.bincount(text, minlength=len(starts) - 1)[: len(starts) - 1]
    offsets = np.zeros(len(starts), np.int64)
    np.cumsum(counts[:-1], out=offsets[1:])
    return (np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)), offsets


def _blocks(data: np.ndarray, starts: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cut the bytes into blocks that end where a text ends or at white space; a longer word stays whole."""
    first = 0
    while first < len(data):
        last = min(first + BLOCK, len(data))
        while last < len(data):
            end = starts[np.searchsorted(starts, last, "right") - 1]
            if end > first:
                last = int(end)
                break
            space = np.flatnonzero(_SPACE[data[first:last]])
            if len(space):
                last = first + int(space[-1]) + 1
                break
            last = min(last + BLOCK, len(data))
        yield first, last
        first = last


def windows(hashes: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each run of ``n`` words within a text, and, per text, where its runs begin.

    A text with words, but fewer than ``n``, has one run: all its words.
    """
    count = np.diff(offsets)
    runs = np.where(count >= n, count - n + 1, np.minimum(count, 1))
    out_offsets = np.zeros(len(offsets), np.int64)
    np.cumsum(runs, out=out_offsets[1:])
    if not out_offsets[-1]:
        return np.zeros(0, np.uint64), out_offsets
    at = np.arange(out_offsets[-1]) - np.repeat(out_offsets[:-1] - offsets[:-1], runs)
    left = np.repeat(offsets[1:], runs) - at
    out = np.zeros(len(at), np.uint64)
    for k in range(n):
        here = left > k
        step = np.where(here, hashes[np.minimum(at + k, len(hashes) - 1)], np.uint64(k + 1))
        out = mix(out + step + np.uint64(0x632BE59BD9B4E019))
    return out, out_offsets


def slices(batch: pa.RecordBatch, column: str, size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts in ``column`` take about ``size`` bytes; a longer text makes a part of its own."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(lengths, dtype=np.int64) // size
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for first, last in zip(cuts, cuts[1:]):
        if last > first:
            yield batch.slice(first, last - first)


def distinct(values: np.ndarray) -> np.ndarray:
    """The distinct values in ascending order."""
    values = np.sort(values)
    return values[np.concatenate(([True], values[1:] != values[:-1]))] if len(values) else values
