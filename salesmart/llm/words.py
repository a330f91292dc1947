"""Words and word shingles of Arrow string columns, as numpy arrays.

A word is a run of bytes outside ``[\\x20\\x09-\\x0D]`` of the UTF-8 text; A-Z
are lower-cased, nothing else is. A shingle is five consecutive words (the
whole sequence when a text has fewer). Words and shingles are represented by
64-bit hashes; every function works on whole texts and on many rows at once,
in slices of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SHINGLE_WORDS = 5
SLICE_BYTES = 1 << 19  # text bytes handled by one set of numpy temporaries

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_PLAIN = np.arange(1, 257, dtype=np.uint64)
_LOWER = _PLAIN.copy()
_LOWER[65:91] += np.uint64(32)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: spreads every input bit over the word."""
    x = x.astype(np.uint64, copy=True)
    x += np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _weights(n: int, salt: int) -> np.ndarray:
    return mix(np.arange(n, dtype=np.uint64) + np.uint64(salt)) | np.uint64(1)


_POSITION = _weights(1024, 0x51ED27)
_ORDER = _weights(SHINGLE_WORDS, 0xA11CE)


def _position_weights(n: int) -> np.ndarray:
    global _POSITION
    if n > len(_POSITION):
        _POSITION = _weights(n, 0x51ED27)
    return _POSITION


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets (n + 1) of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, off - off[0]


def word_spans(raw: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and length of every word, in order, and the index of each row's
    first word (n + 1 entries). ``space`` says which bytes separate words."""
    gap = space[raw]
    row_start = np.zeros(len(raw) + 1, bool)
    row_start[offsets] = True
    row_start[-1] = True
    first = ~gap
    first[1:] &= gap[:-1] | row_start[1:-1]
    last = ~gap
    last[:-1] &= gap[1:] | row_start[1:-1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1 - starts, np.searchsorted(starts, offsets)


def span_hashes(raw: np.ndarray, starts: np.ndarray, lengths: np.ndarray, lower: bool = True) -> np.ndarray:
    """64-bit hash of each span, in slices cut between spans."""
    out = np.zeros(len(starts), np.uint64)
    table = _LOWER if lower else _PLAIN
    done = np.cumsum(lengths)
    i = 0
    while i < len(starts):
        before = done[i - 1] if i else 0
        j = max(i + 1, int(np.searchsorted(done, before + SLICE_BYTES)))
        size = lengths[i:j]
        first = np.cumsum(size) - size
        at = np.arange(int(size.sum())) - np.repeat(first, size)
        value = table[raw[np.repeat(starts[i:j], size) + at]] * _position_weights(int(size.max()))[at]
        out[i:j] = np.add.reduceat(value, first)
        i = j
    return mix(out)


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, in order, and the index of each row's first word."""
    starts, lengths, bounds = word_spans(raw, offsets)
    return span_hashes(raw, starts, lengths), bounds


def shingle_hashes(words: np.ndarray, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Hash of every shingle of ``size`` words (five at most) of one text, in
    order, repeats kept; fewer words give one shingle, no word none."""
    n = len(words)
    if not n:
        return words
    k = min(n, size)
    total = np.full(n - k + 1, np.uint64(k), np.uint64)
    for j in range(k):
        total += words[j : n - k + 1 + j] * _ORDER[j]
    return mix(total)


def row_slices(raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``SLICE_BYTES`` of text (one row at least)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + SLICE_BYTES, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def texts_words(column: pa.Array) -> Iterator[np.ndarray]:
    """Word hashes, in order, of each text of a column."""
    raw, offsets = text_buffer(column)
    for i, j in row_slices(raw, offsets):
        off = offsets[i : j + 1] - offsets[i]
        words, bounds = word_hashes(raw[offsets[i] : offsets[j]], off)
        for a, b in zip(bounds[:-1], bounds[1:]):
            yield words[a:b]


def texts_shingles(column: pa.Array) -> Iterator[np.ndarray]:
    """Shingle hashes (in order, repeats kept) of each text of a column."""
    for words in texts_words(column):
        yield shingle_hashes(words)
