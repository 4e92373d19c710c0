"""Vectorised word handling over Arrow string columns (used inside ``mapInArrow`` tasks).

A word is a maximal run of bytes other than space, tab, LF, VT, FF and CR, i.e.
``[^\\x20\\x09-\\x0D]+``. Those six bytes never occur inside a UTF-8 sequence, so words can
be cut on bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_powers = np.ones(1, dtype=np.uint64)


def powers(n: int) -> np.ndarray:
    """``_BASE ** i`` modulo 2**64 for i < n (grown on demand)."""
    global _powers
    if n > len(_powers):
        with np.errstate(over="ignore"):
            _powers = np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(max(n, 4096), _BASE))))
    return _powers[:n]


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64), element by element."""
    with np.errstate(over="ignore"):
        x = x + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null counts as an empty text."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_binary()).fill_null(b"")
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64)[column.offset: column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.empty(0, np.uint8)
    return data[offsets[0]: offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = 2 << 20):
    """Cut a batch so that each part holds about ``max_bytes`` of text, or one longer text."""
    if not batch.num_rows:
        return
    sizes = np.diff(utf8(batch.column(column))[1])
    begin, held = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > begin and held + n > max_bytes:
            yield batch.slice(begin, i - begin)
            begin, held = i, 0
        held += n
    yield batch.slice(begin)


class Words:
    """Words of all texts of a column: byte bounds, 64-bit hashes and each text's range."""

    def __init__(self, column: pa.Array, hashes: bool = True):
        self.data, self.offsets = utf8(column)
        d, o, n = self.data, self.offsets, len(self.data)
        word = _IS_WORD[d]
        start, end = word.copy(), word.copy()
        start[1:] &= ~word[:-1]
        end[:-1] &= ~word[1:]
        full = np.flatnonzero(np.diff(o))
        start[o[full]] = word[o[full]]
        end[o[full + 1] - 1] = word[o[full + 1] - 1]
        self.starts = np.flatnonzero(start)
        self.ends = np.flatnonzero(end) + 1
        #: text i has the words bounds[i] to bounds[i + 1]
        self.bounds = np.searchsorted(self.starts, o)
        if hashes:
            if not len(self.starts):
                self.hashes = np.empty(0, np.uint64)
                return
            index = np.arange(n)
            at = index - np.maximum.accumulate(np.where(start, index, 0))  # place in its word
            longest = int((self.ends - self.starts).max())
            at[~word] = 0
            with np.errstate(over="ignore"):
                part = (d.astype(np.uint64) + np.uint64(1)) * powers(longest)[at]
            part[~word] = 0
            self.hashes = mix64(np.add.reduceat(part, self.starts))

    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)


def gram_hashes(hashes: np.ndarray, bounds: np.ndarray, n: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``n`` words inside one text; and each text's range of them.

    The hash of a run is a polynomial in its word hashes, from prefix sums in O(words).
    """
    total = len(hashes)
    counts = np.maximum(np.diff(bounds) - n + 1, 0)
    ranges = np.concatenate(([0], np.cumsum(counts)))
    if not ranges[-1]:
        return np.empty(0, np.uint64), ranges
    with np.errstate(over="ignore"):
        h = hashes ^ np.uint64(seed * 0x5851F42D4C957F2D & 0xFFFFFFFFFFFFFFFF)
        h = mix64(h) if seed else h
        p = np.uint64(0xD6E8FEB86659FD93)
        out = np.zeros(total - n + 1, np.uint64)
        # Horner by doubling: value(k words) for k = 1, 2, 4, ...
        width, value, power = 1, h, p
        done, need = 0, n
        while need:
            if need & 1:
                part = value[done: done + total - n + 1]
                out = out * power + part
                done += width
            need >>= 1
            if need:
                value = value[:len(value) - width] * power + value[width:]
                width, power = width * 2, power * power
    starts = np.repeat(bounds[:-1], counts) + (np.arange(ranges[-1]) - np.repeat(ranges[:-1], counts))
    return mix64(out[starts]), ranges
