"""Words and shingles of a batch of texts as arrays of 64-bit numbers.

Runs inside tasks. Bytes of an Arrow column are looked at where they lie, in blocks of a
few megabytes, so that memory follows the block and the longest text, not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 21
SHINGLE = 5

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash, as in splitmix64."""
    x = x.astype(np.uint64, copy=True)
    x += np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mixed(np.arange(256, dtype=np.uint64) + np.uint64(1000))
_LAG = mixed(np.arange(64, dtype=np.uint64) + np.uint64(5000)) | np.uint64(1)


def buffer_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and where each text starts and ends in them; null is empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(offsets: np.ndarray, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows that hold about ``size`` bytes; a longer text is a run of its own."""
    at, n = 0, len(offsets) - 1
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        yield at, min(end, n)
        at = min(end, n)


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word in a block, and how many words each text has.

    Words are runs of bytes other than space and 0x09 to 0x0D; ``lower`` folds A to Z only.
    """
    base = offsets[0]
    offsets = offsets - base
    data = data[base : base + offsets[-1]]
    n = len(offsets) - 1
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(n, np.int64)
    solid = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = solid.copy()
    starts[1:] &= ~solid[:-1] | edge[1:-1]
    first = np.flatnonzero(starts)
    if not len(first):
        return np.zeros(0, np.uint64), np.zeros(n, np.int64)
    per_text = np.diff(np.searchsorted(first, offsets))
    kept = data[solid]
    if lower:
        kept = _LOWER[kept]
    rank = np.cumsum(solid, dtype=np.int64) - 1
    at = rank[first]
    lengths = np.diff(np.append(at, len(kept)))
    place = np.arange(len(kept), dtype=np.int64) - np.repeat(at, lengths)
    factor = mixed(np.arange(int(lengths.max()), dtype=np.uint64)) | np.uint64(1)
    sums = np.add.reduceat(_BYTE[kept] * factor[place], at)
    return mixed(sums + lengths.astype(np.uint64) * _LAG[63]), per_text


def run_hashes(words: np.ndarray, per_text: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``size`` words within a text, in order, and how many each text has."""
    counts = np.maximum(per_text - size + 1, 0)
    if len(words) < size:
        return np.zeros(0, np.uint64), counts
    sums = np.zeros(len(words) - size + 1, np.uint64)
    for k in range(size):
        sums += words[k : k + len(sums)] * _LAG[k]
    ends = np.cumsum(per_text)
    left = np.repeat(ends, per_text)[: len(sums)] - np.arange(len(sums))
    return mixed(sums[left >= size]), counts


def shingles(words: np.ndarray, per_text: np.ndarray, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """For each text the sorted, distinct hashes of its runs of ``size`` words.

    A text with fewer words, but any, has one: the run of all of them.
    """
    runs, counts = run_hashes(words, per_text, size)
    at, word_at = 0, 0
    for n_words, n in zip(per_text.tolist(), counts.tolist()):
        if n:
            own = np.sort(runs[at : at + n])
            keep = np.empty(n, bool)
            keep[0] = True
            np.not_equal(own[1:], own[:-1], out=keep[1:])
            yield own[keep]
        elif n_words:
            short = words[word_at : word_at + n_words] * _LAG[:n_words] + _LAG[62]
            yield mixed(short.sum(keepdims=True, dtype=np.uint64))
        else:
            yield np.zeros(0, np.uint64)
        at += n
        word_at += n_words


def text_shingles(column: pa.Array, lower: bool = True, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """The shingle set of each text of a column, in the column's order."""
    data, offsets = buffer_of(column)
    for a, b in blocks(offsets):
        words, per_text = word_hashes(data, offsets[a : b + 1], lower)
        yield from shingles(words, per_text, size)
