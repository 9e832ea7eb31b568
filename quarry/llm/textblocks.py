"""Vectorised text kernels for Arrow string columns.

A column is read as one byte array plus document offsets and cut into blocks
of whole documents of about ``BLOCK`` bytes, so that the arrays in flight are
bounded by the block (or by the longest document), not by the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 4 << 20

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_KEEP = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [2 ** 64 - 1], dtype=np.uint64)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; NULL reads as empty text."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[at[0]:at[-1]] if len(at) else raw[:0], at - at[0] if len(at) else np.zeros(1, np.int64)


def blocks(column: pa.Array, size: int = BLOCK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, last + 1, bytes, offsets) of consecutive runs of documents."""
    raw, at = column_bytes(column)
    first = 0
    while first < len(at) - 1:
        last = max(first + 1, int(np.searchsorted(at, at[first] + size, side="right")) - 1)
        yield first, last, raw[at[first]:at[last]], at[first:last + 1] - at[first]
        first = last


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (xor-shift and odd multipliers)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_bounds(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and each document's range of words."""
    space = _IS_SPACE[raw]
    before, after = np.empty(len(raw), bool), np.empty(len(raw), bool)
    if len(raw):
        before[0], after[-1] = True, True
        before[1:], after[:-1] = space[:-1], space[1:]
        edge = at[(at > 0) & (at < len(raw))]
        before[edge], after[edge - 1] = True, True
    starts = np.flatnonzero(~space & before)
    ends = np.flatnonzero(~space & after) + 1
    return starts, ends, np.searchsorted(starts, at)


def hash_spans(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span, read eight bytes at a time."""
    padded = np.zeros(len(raw) + 8, np.uint8)
    padded[:len(raw)] = raw
    eight = np.ndarray(shape=(len(raw) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    length = ends - starts
    h = mix(length.astype(np.uint64) * _ODD + _ODD)
    todo, k = np.flatnonzero(length > 0), 0
    while len(todo):
        left = length[todo] - k
        part = eight[starts[todo] + k] & _KEEP[np.minimum(left, 8)]
        h[todo] = mix(h[todo] ^ (part + _ODD)) * _ODD
        k += 8
        todo = todo[left > 8]
    return mix(h)


def words(raw: np.ndarray, at: np.ndarray, fold: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order and each document's offsets into them."""
    raw = _FOLD[raw] if fold else raw
    starts, ends, of = word_bounds(raw, at)
    return hash_spans(raw, starts, ends), of


def shingles(word_hashes: np.ndarray, of: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``k``-word windows and each document's offsets into them.

    A document of 1 to ``k - 1`` words has its whole sequence as one shingle.
    """
    n = len(word_hashes)
    counts = np.diff(of)
    made = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    out_of = np.concatenate([[0], np.cumsum(made)])
    window = np.full(max(n - k + 1, 0), np.uint64(k), np.uint64)
    for j in range(k):
        window = mix(window * _ODD + word_hashes[j:j + len(window)])
    out = np.empty(int(out_of[-1]), np.uint64)
    whole = np.flatnonzero(counts >= k)
    if len(whole):
        first = np.repeat(of[whole] - out_of[whole], made[whole])
        slot = np.concatenate([np.arange(a, b) for a, b in zip(out_of[whole], out_of[whole + 1])])
        out[slot] = window[slot + first]
    for d in np.flatnonzero((counts > 0) & (counts < k)):
        h = np.full(1, np.uint64(counts[d]), np.uint64)
        for j in range(of[d], of[d + 1]):
            h = mix(h * _ODD + word_hashes[j:j + 1])
        out[out_of[d]] = h[0]
    return out, out_of


def distinct_by_document(values: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each document's distinct values in ascending order, and the offsets."""
    parts = [np.unique(values[a:b]) for a, b in zip(of[:-1], of[1:])]
    out_of = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    return (np.concatenate(parts) if parts else values[:0]), out_of


def list_array(values: np.ndarray, of: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(of, pa.int32()), pa.array(values, kind))
