"""Words and their hashes over Arrow text columns, in numpy.

Texts stay UTF-8 bytes in one buffer; nothing here makes a Python object per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_rng = np.random.Generator(np.random.PCG64(20240229))
BYTE_VALUE = _rng.integers(1, 2**63, 256, dtype=np.uint64)
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INV = np.uint64(pow(int(BASE), -1, 2**64))

#: The separators of a word: space and \t to \r.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, *range(9, 14)]] = True
#: A to Z in lower case.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and its inverse for i < n, modulo 2**64."""
    if len(_powers[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        for k, base in enumerate((BASE, BASE_INV)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _powers[k] = np.multiply.accumulate(p)
    return _powers[0][:n], _powers[1]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x7FB5D329728EA185)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x81DADEF4BC2DD44D)
    h ^= h >> np.uint64(33)
    return h


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows in them; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if n == 0 or column.buffers()[1] is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64 if wide else np.int32, n + 1 + column.offset)[column.offset :].astype(np.int64)
    if data is None or off[-1] == off[0]:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    return np.frombuffer(data, np.uint8)[off[0] : off[-1]], off - off[0]


def chunks(column: pa.Array, size: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of whole rows with about ``size`` bytes."""
    data, off = utf8(column)
    a, n = 0, len(off) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + size, "right")) - 1)
        yield a, b, data[off[a] : off[b]], off[a : b + 1] - off[a]
        a = b


def runs(member: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of members inside each row, and the offsets of rows in those."""
    n = len(member)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = member[:-1]
    edge = off[:-1][off[:-1] < n]
    before[edge] = False
    starts = np.flatnonzero(member & ~before)
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = member[1:]
    after[off[1:][off[1:] > 0] - 1] = False
    ends = np.flatnonzero(member & ~after) + 1
    return starts, ends, np.searchsorted(starts, off)


def hash_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of bytes, by differences of one running polynomial."""
    p, inv = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUE[data] * p[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * inv[starts] + (ends - starts).astype(np.uint64))


def hash_points(points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of code points."""
    p, inv = powers(len(points) + 1)
    total = np.zeros(len(points) + 1, np.uint64)
    np.cumsum(mix(points.astype(np.uint64) + np.uint64(1)) * p[: len(points)], out=total[1:])
    return mix((total[ends] - total[starts]) * inv[starts] + (ends - starts).astype(np.uint64))


def shingle_hashes(words: np.ndarray, row_words: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each row's runs of ``width`` words, of its whole words if fewer, and the offsets of rows in them."""
    n = np.diff(row_words)
    count = np.where(n >= width, n - width + 1, np.minimum(n, 1))
    off = np.concatenate([[0], np.cumsum(count)])
    first = np.repeat(row_words[:-1] - off[:-1], count) + np.arange(off[-1])
    out = np.zeros(off[-1], np.uint64)
    if not len(out):
        return out, off
    length = np.repeat(np.minimum(n, width), count)
    last = len(words) - 1
    with np.errstate(over="ignore"):
        for k in range(width):
            step = (out + words[np.minimum(first + k, last)]) * BASE
            out = step if length.min() > k else np.where(length > k, step, out)
        return mix(out + length.astype(np.uint64)), off
