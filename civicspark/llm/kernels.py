"""Vectorised byte kernels shared by the operators that run numpy inside Spark tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_MASK = (1 << 64) - 1
#: An odd multiplier, so that its powers can be inverted modulo 2**64.
_BASE = 0x9E3779B97F4A7C15
#: The bytes that separate words: space, and tab to carriage return.
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column, one after the other, and each row's offset (one more than rows); null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x7FB5D329728EA185)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n + 1, base & _MASK, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def word_hashes(data: np.ndarray, offsets: np.ndarray, *, gap: np.ndarray = _IS_SPACE, prefix: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each lower-cased word and the number of words before each row (one more than rows).

    ``gap`` tells of each byte whether it separates words; with ``prefix`` only so many first bytes of a word count.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    low = _LOWER[data]
    word = ~gap[low]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    edges = offsets[(offsets > 0) & (offsets < n)]
    first[edges] = word[edges]
    last[edges - 1] = word[edges - 1]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    if prefix:
        end = np.minimum(end, begin + prefix)
    # sum(byte * base**place) over a word, moved back to place 0, depends on the word alone
    power = _powers(n, _BASE)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((low.astype(np.uint64) + np.uint64(1)) * power[:n], out=total[1:])
    back = _powers(n, pow(_BASE, -1, 1 << 64))
    hashes = mix((total[end] - total[begin]) * back[begin] + (end - begin).astype(np.uint64))
    return hashes, np.searchsorted(begin, offsets)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each row, ascending within the row, as 64-bit hashes, and the number before each row.

    A row with fewer words than a shingle has one shingle, of all its words; a row without words has none.
    """
    rows = len(offsets) - 1
    hashes, at = word_hashes(data, offsets)
    count = np.diff(at)
    shingles = np.where(count >= words, count - words + 1, (count > 0).astype(np.int64))
    total = int(shingles.sum())
    if not total:
        return np.zeros(0, np.uint64), np.zeros(rows + 1, np.int64)
    row = np.repeat(np.arange(rows), shingles)
    start = np.arange(total) - np.repeat(np.cumsum(shingles) - shingles, shingles) + at[row]
    length = np.minimum(count[row], words)
    value = np.zeros(total, np.uint64)
    for k in range(words):
        here = k < length
        step = hashes[np.where(here, start + k, 0)]
        value = np.where(here, mix(value * np.uint64(_BASE) + step), value)
    order = np.lexsort((value, row))
    value, row = value[order], row[order]
    keep = np.ones(total, bool)
    keep[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
    value, row = value[keep], row[keep]
    return value, np.searchsorted(row, np.arange(rows + 1))


def gram_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """A hash of the ``width`` bytes from each place on; the last places, with fewer bytes, have none."""
    n = len(data) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    level, size, out, done = mix(data.astype(np.uint64) + np.uint64(0x1F0D3)), 1, None, 0
    bits = width
    while bits:
        if bits & 1:
            part = level[done : done + n]
            out = part.copy() if out is None else mix(out * np.uint64(_BASE)) + part
            done += size
        bits >>= 1
        if bits:
            level = level[: len(level) - size] * np.uint64(pow(_BASE, size, 1 << 64)) + level[size:]
            size *= 2
    return mix(out)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbouring values."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[: len(values) - size], values[size:])
        size *= 2
    return np.minimum(values[:n], values[width - size : width - size + n])


def words(data: np.ndarray, offsets: np.ndarray, gap: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct words, A-Z lower-cased; of each word its place among these and where it begins; the number of words
    before each row (one more than rows). ``gap`` tells of each byte whether it separates words."""
    n = len(data)
    if not n:
        return pa.array([], pa.large_string()), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    low = _LOWER[data]
    word = ~gap[low]
    first = word.copy()
    first[1:] &= ~word[:-1]
    edges = offsets[(offsets > 0) & (offsets < n)]
    first[edges] = word[edges]
    begin = np.flatnonzero(first)
    # the bytes of words, one word after the other
    ends = np.concatenate([np.cumsum(word)[begin] - 1, [word.sum()]]).astype(np.int64)
    coded = pa.LargeStringArray.from_buffers(len(begin), pa.py_buffer(ends), pa.py_buffer(low[word])).dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy().astype(np.int64), begin, np.searchsorted(begin, offsets)


def slices(offsets: np.ndarray, most: int = 1 << 20) -> list[tuple[int, int]]:
    """Ranges of rows of about ``most`` bytes, a longer row alone."""
    out, lo = [], 0
    while lo < len(offsets) - 1:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, side="right")) - 1)
        out.append((lo, hi))
        lo = hi
    return out
