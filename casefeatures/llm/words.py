"""Words of texts as 64-bit hashes, computed on whole Arrow columns.

Texts are cut into words by a table that says which bytes separate. A word's hash is a sum of random byte values times
powers of an odd number, so that all words of a block come from one running sum; the sum is mixed afterwards. Blocks and
very long texts are taken in pieces of a bounded number of bytes, so memory beside the hashes themselves is bounded.
Results that rest on equal hashes are exact but for collisions of 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

PIECE = 1 << 18
_ODD = np.uint64(0x9E3779B97F4A7C15)
_FOLD = np.uint64(0xD6E8FEB86659FD93)
_C1, _C2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

#: Bytes that are no part of a word of ``[^\x20\x09-\x0D]+``.
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes that are no part of a word of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of a lower-cased text.
MARKS = np.zeros(256, bool)
MARKS[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True


def mix(z: np.ndarray) -> np.ndarray:
    """Spread every bit over all 64, in place."""
    z ^= z >> np.uint64(30)
    z *= _C1
    z ^= z >> np.uint64(27)
    z *= _C2
    z ^= z >> np.uint64(31)
    return z


_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * _ODD)
_VALUE[0x41:0x5B] = _VALUE[0x61:0x7B]  # A-Z count as a-z
_POWERS = np.ones(1, np.uint64)
_INVERSE = np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POWERS, _INVERSE
    if len(_POWERS) < n:
        steps = np.full(n, _FOLD, np.uint64)
        steps[0] = 1
        _POWERS = np.cumprod(steps, dtype=np.uint64)
        steps[1:] = np.uint64(pow(int(_FOLD), -1, 1 << 64))
        _INVERSE = np.cumprod(steps, dtype=np.uint64)
    return _POWERS, _INVERSE


class Words(NamedTuple):
    """Words of some consecutive rows: rows ``first`` to ``last``; row i has words ``at[i]`` to ``at[i + 1]``."""

    first: int
    last: int
    at: np.ndarray
    hashes: np.ndarray
    starts: np.ndarray  # byte offsets in ``data``
    ends: np.ndarray
    data: np.ndarray
    heads: np.ndarray  # where each row begins in ``data``


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a text column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    at = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.empty(0, np.uint8)
    return data, at


def _words(data: np.ndarray, heads: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, starts and ends of the words of a piece; a word never runs over a head."""
    inside = ~separators[data]
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    heads = heads[(heads > 0) & (heads < len(data))]
    start[heads] = inside[heads]
    end[heads - 1] = inside[heads - 1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    powers, inverse = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUE[data] * powers[: len(data)], out=total[1:])
    hashes = (total[ends] - total[starts]) * inverse[starts]
    hashes += (ends - starts).astype(np.uint64) * _ODD
    return mix(hashes), starts, ends


def _long(data: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``_words`` of one text, piece by piece; a piece ends at a separator."""
    found, p, none = [], 0, np.empty(0, np.int64)
    while p < len(data):
        q = min(p + PIECE, len(data))
        while q < len(data):
            gap = np.flatnonzero(separators[data[q : q + PIECE]])
            if len(gap):
                q += int(gap[0])
                break
            q = min(q + PIECE, len(data))
        h, s, e = _words(data[p:q], none, separators)
        found.append((h, s + p, e + p))
        p = q
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def words(column: pa.Array, separators: np.ndarray) -> Iterator[Words]:
    """The words of a column, some rows at a time: about PIECE bytes, or one longer text."""
    data, at = buffers(column)
    i, n = 0, len(at) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + PIECE, "right")) - 1)
        part, heads = data[at[i] : at[j]], at[i : j + 1] - at[i]
        h, s, e = _long(part, separators) if len(part) > PIECE else _words(part, heads, separators)
        yield Words(i, j, np.searchsorted(s, heads), h, s, e, part, heads)
        i = j


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash for each k consecutive words; the caller leaves out those that run over a text's end."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = hashes[:n].copy()
    for i in range(1, k):
        out *= _FOLD
        out += hashes[i : n + i]
    out += np.uint64(k * int(_ODD) & (1 << 64) - 1)
    return mix(out)


def sequence(hashes: np.ndarray) -> int:
    """A hash of all the words given, in order."""
    return int(windows(hashes, len(hashes))[0])


def key(hashes: np.ndarray) -> tuple[int, int]:
    """Two signed 64-bit sums that name a set of hashes."""
    return int(hashes.sum(dtype=np.uint64).view(np.int64)), int(mix(hashes ^ _C1).sum(dtype=np.uint64).view(np.int64))
