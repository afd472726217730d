"""Vectorised views of an Arrow string column: words, hashes and shingles of whole texts.

Words are the maximal runs of bytes outside ``[\\x20\\x09-\\x0D]``.  Everything
works on the UTF-8 buffer of a record batch, so cost is a few numpy passes per
byte.  A batch is cut into runs of whole documents of about CHUNK bytes; a text
is never cut, so the working memory is about 60 times the larger of CHUNK and
the longest single text.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from contextlib import suppress
from functools import wraps
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 18


def trimmed(run):
    """A batch function that gives its free memory back to the system at its end; workers live on, and what they keep counts against the executor."""

    @wraps(run)
    def out(*args):
        try:
            yield from run(*args)
        finally:
            pa.default_memory_pool().release_unused()
            with suppress(OSError, AttributeError):
                ctypes.CDLL(None).malloc_trim(0)

    return out


MUL = np.uint64(0x9E3779B97F4A7C15)
_ODD = 0x5851F42D4C957F2D  # odd, hence invertible modulo 2**64
_INV = pow(_ODD, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser on uint64 (splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_EXACT = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * MUL)
_FOLDED = _EXACT.copy()
_FOLDED[65:91] = _EXACT[97:123]
_powers = {"n": 0, "up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _powers["n"] < n:
        size = max(n, CHUNK) + 1
        for key, base in (("up", _ODD), ("down", _INV)):
            steps = np.full(size, np.uint64(base))
            steps[0] = 1
            _powers[key] = np.cumprod(steps, dtype=np.uint64)
        _powers["n"] = size - 1
    return _powers["up"], _powers["down"]


class Texts(NamedTuple):
    """A run of whole documents: their rows in the batch, bytes and offsets into them."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


def chunks(column: pa.Array, size: int = CHUNK) -> Iterator[Texts]:
    """Runs of whole texts of about ``size`` bytes; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    n = len(column)
    if not n:
        return
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, values = column.buffers()
    offsets = np.frombuffer(offsets, kind)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(values, np.uint8) if values is not None and values.size else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        yield Texts(at, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at])
        at = to


class Words(NamedTuple):
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray  # of each document, the index of its first word, and the total at the end


def words(texts: Texts) -> Words:
    inside = ~SPACE[texts.data]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    stop = inside.copy()
    stop[:-1] &= ~inside[1:]
    edge = texts.offsets[1:-1]
    edge = edge[(edge > 0) & (edge < len(inside))]
    begin[edge] |= inside[edge]
    stop[edge - 1] |= inside[edge - 1]
    start = np.flatnonzero(begin)
    return Words(start, np.flatnonzero(stop) + 1, np.searchsorted(start, texts.offsets))


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, fold: bool) -> np.ndarray:
    """64-bit hash of each byte span; ``fold`` takes A-Z as a-z."""
    up, down = _power(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_FOLDED if fold else _EXACT)[data] * up[: len(data)], out=total[1:])
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64) * MUL)


_K = mix(np.arange(11, 19, dtype=np.uint64) * MUL) | np.uint64(1)


def shingle_sets(texts: Texts, width: int = 5) -> list[np.ndarray]:
    """Of each document the sorted distinct hashes of its word shingles.

    Fewer than ``width`` words: the whole sequence is the one shingle.  No words: an empty set.
    """
    w = words(texts)
    h = span_hashes(texts.data, w.start, w.end, fold=True)
    n = len(h)
    total = np.zeros(max(0, n - width + 1), np.uint64)
    for k in range(width):
        total += h[k : k + len(total)] * _K[k]
    total = mix(total)
    out = []
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist()):
        if b - a >= width:
            x = np.sort(total[a : b - width + 1])
            keep = np.ones(len(x), bool)
            np.not_equal(x[1:], x[:-1], out=keep[1:])
            out.append(x[keep])
        elif b > a:
            short = (h[a:b] * _K[: b - a]).sum(dtype=np.uint64, keepdims=True)
            out.append(mix(short + np.array([b - a], np.uint64) * MUL))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
