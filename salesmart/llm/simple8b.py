"""Simple-8b word-aligned coding of ids, vectorised in numpy.

A 64-bit word is a 4-bit selector (high bits) and 60 bits of payload; selector
``s`` says that the payload holds ``COUNTS[s]`` values of ``60 // COUNTS[s]``
bits, the first one lowest. Selector 0 is the escape: the payload is the index
of a value of more than 60 bits in the segment's table of escapes. Values are
packed in blocks of ``BLOCK`` ids, words never cross a block, and the segment
lists the first word of every block, so any block is decoded on its own and all
blocks are coded and decoded together.

A segment (little-endian): the header, then ``docs`` ids of documents (int64),
``docs`` flags (bit 0: the id is null, bit 1: the document goes on from the
segment before, bit 2: it goes on in the next), ``docs`` id counts (int64),
``blocks`` first words (int64), ``words`` words and ``escapes`` values (uint64).
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np

# The values a word holds, by selector (0: escape).
COUNTS = np.array([1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1, 1], np.int64)
BITS = 60 // COUNTS
ESCAPE = 0
LAST = 14  # one value of 60 bits
BLOCK = 512
MAGIC = b"S8B1"
_HEADER = struct.Struct("<4sI7Q")  # magic, block, first id, first document, ids, docs, blocks, words, escapes
NULL_ID, GOES_ON_FROM, GOES_ON_IN = 1, 2, 4


def _widths(values: np.ndarray) -> np.ndarray:
    """Bits that each value needs, one at least."""
    if not int(values.max()) >> 53:  # exact as doubles
        return np.maximum(np.frexp(values.astype(np.float64))[1], 1).astype(np.uint8)
    out = np.ones(len(values), np.uint8)
    for bit in range(1, max(1, int(values.max()).bit_length())):
        out += values >> np.uint64(bit) != 0
    return out


def _selectors(width: np.ndarray, room: np.ndarray) -> np.ndarray:
    """For every position, the selector of a word that begins there: the one
    with most values such that all fit, cut to the ``room`` left in its block."""
    n = len(width)

    def shifted(a: np.ndarray, by: int) -> np.ndarray:
        out = np.zeros(n, np.uint8)
        out[:max(0, n - by)] = a[by:]
        return out

    most = {1: width}  # widest of the next k values; beyond the block counts as 0
    inside = np.minimum(room, 255).astype(np.uint8)

    def over(k: int) -> np.ndarray:
        if k not in most:
            half = 1 << ((k - 1).bit_length() - 1)
            rest = k - half
            later = np.where(inside > half, shifted(over(rest), half), np.uint8(0))
            most[k] = np.maximum(over(half), later)
        return most[k]

    best = np.full(n, ESCAPE, np.uint8)
    for s in range(LAST, 0, -1):
        fits = over(int(COUNTS[s])) <= BITS[s].astype(np.uint8)
        if not fits.any():  # nor would more values
            break
        np.copyto(best, np.uint8(s), where=fits)
    return best


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, first word of each block, and escapes of a run of ids."""
    values = np.ascontiguousarray(values, np.uint64)
    n = len(values)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    room = np.resize(np.arange(BLOCK, 0, -1, dtype=np.int16), n)
    last = n - n % BLOCK
    room[last:] = np.arange(n - last, 0, -1)
    selector = _selectors(_widths(values), room)
    step = np.minimum(COUNTS.astype(np.int16)[selector], room)
    # All blocks walk their words at once.
    at, end = np.arange(0, n, BLOCK), np.minimum(np.arange(0, n, BLOCK) + BLOCK, n)
    begins = np.zeros(n, bool)
    while len(at):
        begins[at] = True
        at = at + step[at]
        open_ = at < end
        at, end = at[open_], end[open_]
    start = np.flatnonzero(begins)
    chosen, count = selector[start].astype(np.int64), step[start]
    words = chosen.astype(np.uint64) << np.uint64(60)
    large = np.flatnonzero(chosen == ESCAPE)
    words[large] |= np.arange(len(large), dtype=np.uint64)
    part, k = np.flatnonzero(chosen != ESCAPE), 0
    while len(part):
        words[part] |= values[start[part] + k] << (BITS[chosen[part]] * k).astype(np.uint64)
        k += 1
        part = part[count[part] > k]
    return words, np.searchsorted(start, np.arange(0, n, BLOCK)), values[start[large]]


def decode(words: np.ndarray, first: np.ndarray, escapes: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` ids of a run of whole blocks; ``first`` counts from words[0]."""
    out = np.zeros(n, np.uint64)
    if not n:
        return out
    selector = (words >> np.uint64(60)).astype(np.int64)
    count = COUNTS[selector]
    ahead = np.cumsum(count) - count
    block = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(words))))
    at = ahead - ahead[first][block] + block * BLOCK
    end = np.minimum((block + 1) * BLOCK, n)
    payload = words & np.uint64((1 << 60) - 1)
    for s in np.unique(selector):
        mine = np.flatnonzero(selector == s)
        if s == ESCAPE:
            out[at[mine]] = escapes[payload[mine].astype(np.int64)]
            continue
        mask = np.uint64((1 << int(BITS[s])) - 1)
        for k in range(int(COUNTS[s])):
            place = at[mine] + k
            inside = place < end[mine]
            mine = mine if inside.all() else mine[inside]
            out[at[mine] + k] = payload[mine] >> np.uint64(int(BITS[s]) * k) & mask
    return out


@dataclass
class Segment:
    """A run of ids of consecutive documents. ``first_id`` and ``first_doc``
    count from the start of its part of the data set."""
    first_id: int
    first_doc: int
    doc_ids: np.ndarray
    flags: np.ndarray
    counts: np.ndarray
    ids: np.ndarray

    def to_bytes(self) -> bytes:
        words, first, escapes = encode(self.ids)
        head = _HEADER.pack(MAGIC, BLOCK, self.first_id, self.first_doc, len(self.ids), len(self.doc_ids), len(first),
                            len(words), len(escapes))
        parts = (self.doc_ids.astype("<i8"), self.flags.astype("u1"), self.counts.astype("<i8"), first.astype("<i8"),
                 words.astype("<u8"), escapes.astype("<u8"))
        return b"".join([head, *[p.tobytes() for p in parts]])


class SegmentView:
    """A written segment; ids are decoded block by block as asked for."""

    def __init__(self, data: bytes):
        magic, block, self.first_id, self.first_doc, self.n_ids, docs, blocks, words, escapes = _HEADER.unpack_from(data)
        if magic != MAGIC or block != BLOCK:
            raise ValueError("not a segment of this format")
        at = _HEADER.size

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, n, at)
            at += out.nbytes
            return out

        self.doc_ids, self.flags, self.counts = take("<i8", docs), take("u1", docs), take("<i8", docs)
        self.first, self.words, self.escapes = take("<i8", blocks), take("<u8", words), take("<u8", escapes)
        if at != len(data):
            raise ValueError(f"segment of {len(data)} bytes, {at} expected")

    def ids(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids from ``start`` to ``stop``; only their blocks are decoded."""
        stop = self.n_ids if stop is None else min(stop, self.n_ids)
        if start >= stop:
            return np.zeros(0, np.uint64)
        a, b = start // BLOCK, -(-stop // BLOCK)
        bounds = np.append(self.first, len(self.words))[a:b + 1]
        found = decode(self.words[bounds[0]:bounds[-1]], bounds[:-1] - bounds[0], self.escapes, min(b * BLOCK, self.n_ids) - a * BLOCK)
        return found[start - a * BLOCK:stop - a * BLOCK]
