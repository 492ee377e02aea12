"""Hashed sets of five-word shingles, for whole batches of texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

WORDS = 5
_PIECE = 4_000_000
_RANDOM = np.random.Generator(np.random.PCG64(20260101))
_BYTE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_PLACE = _RANDOM.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijection of 64-bit numbers whose bits depend on all bits of x."""
    x = x + np.uint64((salt + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _places(longest: int) -> np.ndarray:
    """Odd multipliers of the places in a word; extended by squaring steps for long words."""
    global _PLACE
    while len(_PLACE) < longest:
        _PLACE = np.concatenate([_PLACE, mixed(_PLACE, len(_PLACE)) | np.uint64(1)])
    return _PLACE


def _piece_words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of concatenated texts and the number of words before each bound (text start)."""
    solid = ~_SPACE[data]
    start = solid.copy()
    start[1:] &= ~solid[:-1]
    inner = bounds[(bounds > 0) & (bounds < len(data))]
    start[inner] = solid[inner]
    starts = np.flatnonzero(start)
    counts = np.searchsorted(starts, bounds)
    if not len(starts):
        return np.empty(0, np.uint64), counts
    used = np.flatnonzero(solid)
    word = np.cumsum(start)[used] - 1
    place = used - starts[word]
    terms = (_BYTE[data[used]] + np.uint64(1)) * _places(int(place.max()) + 1)[place]
    first = np.searchsorted(used, starts)
    return mixed(np.add.reduceat(terms ^ (terms >> np.uint64(32)), first)), counts


def _pieces(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Word hashes and words of each text, a few megabytes at a time; long texts are cut at white space."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + _PIECE, "right")) - 1)
        lo, hi = int(offsets[first]), int(offsets[last])
        if hi - lo <= 2 * _PIECE:
            words, counts = _piece_words(data[lo:hi], offsets[first : last + 1] - lo)
            yield words, np.diff(counts)
        else:
            parts = []
            while lo < hi:
                cut = min(hi, lo + _PIECE)
                while cut < hi and not _SPACE[data[cut]]:
                    cut += 1
                parts.append(_piece_words(data[lo:cut], np.array([0, cut - lo]))[0])
                lo = cut
            words = np.concatenate(parts)
            yield words, np.array([len(words)])
        first = last


def _sets(words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    ends = np.cumsum(counts)
    begins = ends - counts
    windows = np.maximum(counts - WORDS + 1, 0)
    short = np.flatnonzero((counts > 0) & (counts < WORDS))
    windows[short] = 1
    offsets = np.concatenate([[0], np.cumsum(windows)])
    values = np.empty(offsets[-1], np.uint64)
    if len(words) >= WORDS:
        n = len(words) - WORDS + 1
        at = sum((words[i : i + n] * _PLACE[i] for i in range(WORDS)), np.zeros(n, np.uint64))
        at = mixed(at)
        own = np.repeat(np.arange(len(counts)), windows)
        full = counts[own] >= WORDS
        index = begins[own] + np.arange(offsets[-1]) - offsets[own]
        values[full] = at[index[full]]
    for i in short:
        part = words[begins[i] : ends[i]]
        values[offsets[i]] = mixed(np.array([np.sum(part * _PLACE[: len(part)]) + np.uint64(len(part))]), 9)[0]
    for i in np.flatnonzero(windows > 1):
        values[offsets[i] : offsets[i + 1]].sort()
    if not len(values):
        return values, offsets
    fresh = np.ones(len(values), bool)
    fresh[1:] = values[1:] != values[:-1]
    fresh[offsets[:-1][windows > 0]] = True
    return values[fresh], np.concatenate([[0], np.cumsum(fresh)])[offsets]


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of UTF-8 texts (bytes and n + 1 offsets), with their own offsets.

    A-Z count as a-z. Fewer than five words make one shingle; no word makes an empty set.
    """
    values, sizes = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    for words, counts in _pieces(data, offsets):
        got, own = _sets(words, counts)
        values.append(got)
        sizes.append(np.diff(own))
    return np.concatenate(values), np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int64)


def arrow_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow string column; null is empty."""
    import pyarrow as pa

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column) or data is None:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]
