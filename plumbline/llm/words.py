"""Vectorised words of UTF-8 text: places, 64-bit names, and XXH64 of slices.

Everything works on the bytes of an Arrow string column. Texts are taken in groups of bounded
size, so that a batch needs a few times its bytes however long its texts are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

U = np.uint64
#: Bytes of text that are worked on at once, but for a longer single text.
GROUP = 2 << 20
#: Bytes for which powers are kept; slices are hashed in segments of at most this many bytes.
SEGMENT = 1 << 20

IS_WORD = np.ones(256, bool)
IS_WORD[[9, 10, 11, 12, 13, 32]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Odd, so that it has an inverse mod 2^64.
BASE = 0x9E3779B97F4A7C15
_NAMES = np.random.RandomState(20240229).randint(1, 2**63 - 1, 256, dtype=np.int64).astype(U)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, U)
    out[0] = 1
    return np.multiply.accumulate(out)


_POW: np.ndarray | None = None
_INV: np.ndarray | None = None


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse, up to SEGMENT."""
    global _POW, _INV
    if _POW is None:
        _POW, _INV = _powers(BASE, SEGMENT + 1), _powers(pow(BASE, -1, 2**64), SEGMENT + 1)
    return _POW, _INV


def mix64(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = h ^ (h >> U(30))
    h = h * U(0xBF58476D1CE4E5B9)
    h ^= h >> U(27)
    h *= U(0x94D049BB133111EB)
    h ^= h >> U(31)
    return h


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (int64, n + 1) of a string column; nulls are empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    return data, offsets


def groups(offsets: np.ndarray, limit: int = GROUP) -> Iterator[tuple[int, int]]:
    """Ranges of texts with at most ``limit`` bytes, or one text."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def word_segments(raw: np.ndarray, overlap: int, limit: int) -> Iterator[tuple[np.ndarray, int]]:
    """One text in segments of about ``limit`` bytes: their bytes, and the place of their first word.

    They end behind a word, and each begins with the last ``overlap`` words of the one before, so every
    run of overlap + 1 words lies in exactly one of them.
    """
    at, base, size, n = 0, 0, limit, len(raw)
    while True:
        end = min(n, at + size)
        while end < n and IS_WORD[raw[end]]:
            blank = np.flatnonzero(~IS_WORD[raw[end : end + 65536]])
            end = end + int(blank[0]) if len(blank) else min(n, end + 65536)
        starts, _, _ = word_bounds(raw[at:end], np.array([0, end - at]))
        if end < n and len(starts) <= overlap:  # long words
            size *= 2
            continue
        yield raw[at:end], base
        if end == n:
            return
        new = len(starts) - overlap
        at, base, size = (at + int(starts[new]) if overlap else end), base + new, limit


def parts(column: pa.Array, overlap: int, limit: int = GROUP) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, int]]:
    """Texts lo .. hi-1, their bytes and offsets, and 0; a longer text comes in word segments, each with its first word's place."""
    data, offsets = texts(column)
    for lo, hi in groups(offsets, limit):
        raw, at = group_bytes(data, offsets, lo, hi)
        if hi - lo > 1 or len(raw) <= limit:
            yield lo, hi, raw, at, 0
            continue
        for segment, base in word_segments(raw, overlap, limit):
            yield lo, hi, segment, np.array([0, len(segment)]), base


def group_bytes(data: np.ndarray, offsets: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of texts lo .. hi-1 and their offsets from 0."""
    return data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words, and each text's first word (n + 1). Words never cross texts."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = IS_WORD[data]
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    start[cuts] = inside[cuts]
    end[cuts - 1] = inside[cuts - 1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def _long_sum(data: np.ndarray) -> int:
    """The polynomial hash of one slice, a segment at a time."""
    total, step = 0, pow(BASE, SEGMENT, 2**64)
    for k in reversed(range(0, len(data), SEGMENT)):
        part = data[k : k + SEGMENT]
        total = (total * step + int(np.sum(_NAMES[part] * _tables()[0][: len(part)], dtype=U))) % 2**64
    return total


def slice_names(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit names of slices, given in order and disjoint: a polynomial hash, mixed with the length."""
    out, i, n = np.zeros(len(starts), U), 0, len(starts)
    while i < n:
        a = int(starts[i])
        if ends[i] - a > SEGMENT:
            out[i] = _long_sum(data[a : ends[i]])
            i += 1
            continue
        j = int(np.searchsorted(ends, a + SEGMENT, "right"))
        b = int(ends[j - 1])
        power, inverse = _tables()
        sums = np.zeros(b - a + 1, U)
        np.cumsum(_NAMES[data[a:b]] * power[: b - a], out=sums[1:])
        s, e = starts[i:j] - a, ends[i:j] - a
        out[i:j] = (sums[e] - sums[s]) * inverse[s]
        i = j
    return mix64(out + (ends - starts).astype(U))


def runs_names(names: np.ndarray, k: int) -> np.ndarray:
    """Names of all runs of ``k`` neighbours (len - k + 1); runs that cross texts are not told apart."""
    n = len(names) - k + 1
    if n <= 0:
        return np.zeros(0, U)
    h = np.zeros(n, U)
    for j in range(k):
        h *= U(BASE)
        h += names[j : j + n]
    return mix64(h)


def run_starts(first: np.ndarray, k: int) -> np.ndarray:
    """Places of the runs of ``k`` words that lie within one text, and never past its end."""
    n = first[-1]
    inside = np.zeros(n + 1, np.int32)
    lengths = np.diff(first)
    lo, hi = first[:-1][lengths >= k], (first[1:] - k + 1)[lengths >= k]
    inside[lo] += 1
    np.subtract.at(inside, hi, 1)
    return np.flatnonzero(np.cumsum(inside[:n]))


_P1, _P2, _P3, _P4, _P5 = (U(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))  # fixed values of XXH64


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << U(r)) | (x >> U(64 - r))


def xxh64_slices(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 42) -> np.ndarray:
    """XXH64 of each slice. Slices of one length step through the rounds together."""
    n = len(starts)
    if not n:
        return np.zeros(0, U)
    lengths = ends - starts
    short = lengths < 32
    out = np.empty(n, U)
    if not short.all():
        whole = data.tobytes()
        at = np.flatnonzero(~short)
        out[at] = np.fromiter((xxhash.xxh64_intdigest(whole[a:b], seed) for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)), U, len(at))
    at = np.flatnonzero(short)
    at = at[np.argsort(lengths[at].astype(np.uint8), kind="stable")]
    pos, size = starts[at], lengths[at]
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    eight = np.lib.stride_tricks.as_strided(padded[:8].view("<u8"), (len(data) + 1,), (1,))
    four = np.lib.stride_tricks.as_strided(padded[:4].view("<u4"), (len(data) + 1,), (1,))
    h = U((seed + int(_P5)) % 2**64) + size.astype(U)
    for j in range(3):
        lo = int(np.searchsorted(size, 8 * (j + 1)))
        if lo == len(size):
            break
        k = eight[pos[lo:] + 8 * j] * _P2
        k = _rotl(k, 31) * _P1
        h[lo:] = _rotl(h[lo:] ^ k, 27) * _P1 + _P4
    done = size & ~7
    has4 = np.flatnonzero(size & 4)
    h[has4] = _rotl(h[has4] ^ (four[pos[has4] + done[has4]].astype(U) * _P1), 23) * _P2 + _P3
    done += size & 4
    for j in range(3):
        has = np.flatnonzero((size & 3) > j)
        h[has] = _rotl(h[has] ^ (padded[pos[has] + done[has] + j].astype(U) * _P5), 11) * _P1
    h ^= h >> U(33)
    h *= _P2
    h ^= h >> U(29)
    h *= _P3
    h ^= h >> U(32)
    out[at] = h
    return out
