"""Vectorised word and word n-gram hashing over Arrow string columns.

Words never become Python objects: a block of texts stays one byte array, and a
word is a (start, end) pair plus a 64-bit hash.  Blocks hold about BLOCK bytes,
so memory does not depend on the batch size; a longer text is cut at separators.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 19
_U = np.uint64
_ODD = 0x9E3779B97F4A7C15
_ODD2 = 0xD6E8FEB86659FD93


def _table(ranges: list[tuple[int, int]]) -> np.ndarray:
    out = np.zeros(256, bool)
    for a, b in ranges:
        out[a : b + 1] = True
    return out


#: Separators of words [^\x20\x09-\x0D]+
SPACES = _table([(0x20, 0x20), (0x09, 0x0D)])
#: Separators of words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+
PUNCTUATION = _table([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler of 64-bit integers."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(32)
    x *= _U(0xD6E8FEB86659FD93)
    x ^= x >> _U(32)
    x *= _U(0xC2B2AE3D27D4EB4F)
    x ^= x >> _U(29)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _U(_ODD))


_TABLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(odd: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least n powers of odd and of its inverse modulo 2^64; one pair of tables per base is kept."""
    have = _TABLES.get(odd)
    if have is None or len(have[0]) < n:
        size, out = max(1 << 18, 1 << (max(n, 1) - 1).bit_length()), []
        for base in (odd, pow(odd, -1, 2**64)):
            p = np.full(size, _U(base), _U)
            p[0] = 1
            np.multiply.accumulate(p, out=p)
            out.append(p)
        _TABLES[odd] = have = (out[0], out[1])
    return have


@dataclass
class Words:
    """Words of a block of documents; doc i has words ptr[i]:ptr[i+1]."""

    start: np.ndarray
    end: np.ndarray
    ptr: np.ndarray
    hash: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.ptr)

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.ptr) - 1), self.counts())


def text_blocks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of about BLOCK bytes each; a NULL text is empty."""
    arr = pc.fill_null(column.cast(pa.large_binary()), b"")
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    n = len(arr)
    if n == 0:
        return
    bufs = arr.buffers()
    off = np.frombuffer(bufs[1], np.int64)[arr.offset : arr.offset + n + 1]
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = min(n, max(i + 1, int(np.searchsorted(off, off[i] + BLOCK, "right")) - 1))
        yield i, j, data[off[i] : off[j]], off[i : j + 1] - off[i]
        i = j


def _pieces(data: np.ndarray, off: np.ndarray, sep: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cuts a long block after separators or at document starts."""
    a, n = 0, len(data)
    while n - a > 2 * BLOCK:
        b = a + BLOCK
        while True:
            hits = np.flatnonzero(sep[data[b : b + 4096]])
            if len(hits):
                b += int(hits[0]) + 1
                break
            b += 4096
            if b >= n:
                b = n
                break
        yield a, b
        a = b
    if a < n:
        yield a, n


def tokenize(data: np.ndarray, off: np.ndarray, sep: np.ndarray, lower: bool = False) -> Words:
    starts, ends, hashes = [], [], []
    edges = off[1:-1]
    for a, b in _pieces(data, off, sep):
        raw = data[a:b]
        if lower:
            raw = _LOWER[raw]
        inside = ~sep[raw]
        first = np.empty(len(raw), bool)
        first[0] = inside[0]
        first[1:] = inside[1:] & ~inside[:-1]
        last = np.empty(len(raw), bool)
        last[-1] = inside[-1]
        last[:-1] = inside[:-1] & ~inside[1:]
        cut = edges[(edges > a) & (edges < b)] - a
        if len(cut):  # two documents meet without a separator
            first[cut] = inside[cut]
            last[cut - 1] = inside[cut - 1]
        s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
        power, inverse = _power_tables(_ODD, len(raw))
        total = np.empty(len(raw) + 1, _U)
        total[0] = 0
        np.cumsum(_BYTE[raw] * power[: len(raw)], out=total[1:])
        hashes.append(mix((total[e] - total[s]) * inverse[s] + (e - s).astype(_U)))
        starts.append(s + a)
        ends.append(e + a)
    if not starts:
        z = np.zeros(0, np.int64)
        return Words(z, z, np.zeros(len(off), np.int64), np.zeros(0, _U))
    start = np.concatenate(starts)
    return Words(start, np.concatenate(ends), np.searchsorted(start, off, "left"), np.concatenate(hashes))


def grams(h: np.ndarray, length: int) -> np.ndarray:
    """Hash of h[i:i+length] for every i that has so many followers (document borders are the caller's)."""
    n = len(h) - length + 1
    if n <= 0:
        return np.zeros(0, _U)
    power, inverse = _power_tables(_ODD2, len(h))
    total = np.empty(len(h) + 1, _U)
    total[0] = 0
    np.cumsum(h * power[: len(h)], out=total[1:])
    return mix((total[length:] - total[:-length]) * inverse[:n] + _U(length))


def valid_starts(words: Words, length: int) -> np.ndarray:
    """For each of the len(words) - length + 1 positions: whether the gram stays in its document."""
    n = len(words.hash) - length + 1
    if n <= 0:
        return np.zeros(0, bool)
    stop = np.repeat(words.ptr[1:], words.counts())[:n]
    return np.arange(n) + length <= stop


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of x[i:i+width], by doubling."""
    n = len(x) - width + 1
    if n <= 0:
        return x[:0]
    have, m = 1, x
    while have * 2 <= width:
        m = np.minimum(m[:-have], m[have:])
        have *= 2
    return np.minimum(m[:n], m[width - have : width - have + n])


def pack(array: np.ndarray) -> bytes:
    return np.ascontiguousarray(array).tobytes()


def split_by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, positions in their order) for each bucket present."""
    order = np.argsort(bucket, kind="stable")
    b = bucket[order]
    cuts = np.flatnonzero(np.diff(b)) + 1
    for part in np.split(order, cuts) if len(order) else []:
        yield int(bucket[part[0]]), part
