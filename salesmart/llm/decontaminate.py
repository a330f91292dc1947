"""Benchmark decontamination by SimHash windows and multi-index Hamming blocks.

A benchmark item is searched with windows of its own size: every run of as
many consecutive 5-word shingles as the item has (a shorter document is one
window). An item of one to four words is one shingle of that many words, and
so are its windows. A window similar enough to any item holds shingles of the
benchmark in 0.8 of its places at least; all other windows are skipped, which
loses nothing. The rest get a 128-bit SimHash of their shingles, repeats
weighing more.

Items are indexed by their fingerprints cut into 8 blocks of 16 bits. Two
fingerprints within Hamming distance ``RADIUS`` = 39 differ by at most 4 bits
in one block: each item is listed under every block value within 2 bits, each
window looks up all values within 2 bits of its own, so they meet. Candidates
are checked by their distance and then verified exactly: the weighted Jaccard
similarity of the two shingle bags (sum of smaller counts over sum of larger
counts) must be 0.8 or more.

The index is broadcast in blocks of at most ``ITEM_BLOCK`` items whose size is
checked; a larger benchmark takes one pass over the documents per block.
Documents are read where they lie: no shuffle but for the hits.

Defined cases: an item or document without words matches nothing; an item of
fewer than five words is found in a document of any length; equal items are
each reported; repeated rows give one hit per (doc_id, item_id); null ids are
kept; an empty benchmark or table gives no hits; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.words import SHINGLE_WORDS, mix, shingle_hashes, texts_words

BITS, BLOCKS, RADIUS = 128, 8, 39
BLOCK_BITS = BITS // BLOCKS
ITEM_BLOCK = 1 << 14           # items in one broadcast index
ITEM_BLOCK_SHINGLES = 1 << 22  # and their shingles
PAIRS = 1 << 20                # candidate pairs looked up at a time
SIMILAR_NUM, SIMILAR_DEN = 4, 5

# Block values within half of the bits that one block of a pair may differ in.
_NEAR = np.array([sum(1 << b for b in bits) for k in range(RADIUS // BLOCKS // 2 + 1)
                  for bits in combinations(range(BLOCK_BITS), k)], np.uint16)


def _bit_votes(shingles: np.ndarray) -> np.ndarray:
    """+1 or -1 per fingerprint bit for each shingle (n x BITS)."""
    word = np.stack([mix(shingles ^ np.uint64(k + 1)) for k in range(BITS // 64)], 1)
    bits = np.unpackbits(np.ascontiguousarray(word).view(np.uint8), axis=1, bitorder="little")
    return bits.astype(np.int32) * 2 - 1


def fingerprints(votes: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """SimHash of the windows of ``length`` shingles that begin at ``starts``,
    as 16-bit blocks (windows x BLOCKS)."""
    total = np.concatenate([np.zeros((1, BITS), np.int32), np.cumsum(votes, 0, dtype=np.int32)])
    on = total[starts + length] - total[starts] > 0
    return np.packbits(on, axis=1, bitorder="little").view(np.uint16)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hamming distances of two lists of fingerprints, pair by pair."""
    return np.bitwise_count(np.ascontiguousarray(a ^ b).view(np.uint64)).sum(1, dtype=np.int32)


class ItemIndex:
    """Fingerprints, block tables and shingle bags of a block of items, given
    the shingles of each and how many words a shingle of it has."""

    def __init__(self, ids: list, bags: list[np.ndarray], widths: list[int]):
        self.ids = ids
        self.width = np.array(widths)
        self.length = np.array([len(b) for b in bags])
        self.bags = [np.unique(b, return_counts=True) for b in bags]
        self.prints = np.concatenate([fingerprints(_bit_votes(b), np.zeros(1, int), len(b)) for b in bags])
        owner = np.repeat(np.arange(len(bags)), [len(s) for s, _ in self.bags])
        shingle = np.concatenate([s for s, _ in self.bags])
        order = np.argsort(shingle, kind="stable")
        self.shingle, first = np.unique(shingle[order], return_index=True)
        self.owner, self.owner_at = owner[order].astype(np.int32), np.append(first, len(order))
        self.block = []
        for b in range(BLOCKS):
            value = (self.prints[:, b, None] ^ _NEAR[None, :]).ravel()
            order = np.argsort(value, kind="stable")
            at = np.searchsorted(value[order], np.arange((1 << BLOCK_BITS) + 1))
            self.block.append((at, np.repeat(np.arange(len(bags), dtype=np.int32), len(_NEAR))[order]))

    def near(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, item, distance) of all pairs within the radius."""
        found, apart = [], []
        met = len(_NEAR) * (1 + len(self.ids) * len(_NEAR) >> BLOCK_BITS)  # pairs a window meets in one block
        step = max(1, PAIRS // max(met, len(_NEAR)))
        for i in range(0, len(prints), step):
            part = prints[i:i + step]
            for b, (at, listed) in enumerate(self.block):
                value = (part[:, b, None] ^ _NEAR[None, :]).ravel().astype(np.int64)
                lo = at[value]
                n = at[value + 1] - lo
                window = np.repeat(np.arange(len(value)), n) // len(_NEAR)
                item = listed[np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
                distance = distances(part[window], self.prints[item])
                close = distance <= RADIUS
                found.append((window[close] + i) * len(self.ids) + item[close])
                apart.append(distance[close])
        if not found:
            return np.zeros(0, int), np.zeros(0, int), np.zeros(0, int)
        pair, first = np.unique(np.concatenate(found), return_index=True)
        return pair // len(self.ids), pair % len(self.ids), np.concatenate(apart)[first]


def similarity(bag_a: tuple, bag_b: tuple) -> tuple[int, int]:
    """Weighted Jaccard of two bags as (smaller counts, larger counts)."""
    _, at_a, at_b = np.intersect1d(bag_a[0], bag_b[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(bag_a[1][at_a], bag_b[1][at_b]).sum())
    return both, int(bag_a[1].sum() + bag_b[1].sum()) - both


def search(words: np.ndarray, index: ItemIndex) -> list[tuple]:
    """(item, similarity, first word, shingles, distance) of each item the
    text holds: the verified window nearest to it, the first of equals."""
    best: dict[int, tuple] = {}
    for width in np.unique(index.width):
        if len(words) >= width:
            _search(shingle_hashes(words, width), index, best)
    return [(index.ids[i], *found) for i, found in sorted(best.items())]


def _search(shingles: np.ndarray, index: ItemIndex, best: dict[int, tuple]) -> None:
    """Adds the items whose shingles have as many words as these ones."""
    at = np.minimum(np.searchsorted(index.shingle, shingles), len(index.shingle) - 1)
    held = index.shingle[at] == shingles
    if not held.any():
        return
    seeds = np.unique(at[held])
    owners = np.unique(np.concatenate([index.owner[index.owner_at[k]:index.owner_at[k + 1]] for k in seeds]))
    size = np.minimum(index.length, len(shingles))  # of the windows of each item
    before = np.concatenate([[0], np.cumsum(held)])
    for length in np.unique(size[owners]):
        starts = np.flatnonzero(SIMILAR_DEN * (before[length:] - before[:-length]) >= SIMILAR_NUM * length)
        for some in np.split(starts, np.flatnonzero(np.diff(starts) > length) + 1):  # windows that touch
            if not len(some):
                continue
            base = int(some[0])
            window, item, distance = index.near(
                fingerprints(_bit_votes(shingles[base:some[-1] + length]), some - base, int(length)))
            own = size[item] == length
            window, item, distance = window[own], item[own], distance[own]
            for k in np.lexsort((some[window], distance, item)):
                i, d = int(item[k]), int(distance[k])
                if i in best and best[i][3] <= d:
                    continue
                start = int(some[window[k]])
                both, either = similarity(np.unique(shingles[start:start + length], return_counts=True), index.bags[i])
                if both * SIMILAR_DEN >= either * SIMILAR_NUM:
                    best[i] = (both / either, start, int(length), d)


def item_blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> Iterator[ItemIndex]:
    """Indexes over at most ITEM_BLOCK items each, read block after block."""
    ids, bags, widths, held = [], [], [], 0
    rows = benchmark.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).orderBy("id", "text")
    for row in rows.toLocalIterator():
        words = next(texts_words(pa.array([row["text"]], pa.large_string())))
        if not len(words):
            continue
        ids.append(row["id"])
        bags.append(shingle_hashes(words))
        widths.append(min(len(words), SHINGLE_WORDS))
        held += len(bags[-1])
        if len(ids) >= ITEM_BLOCK or held >= ITEM_BLOCK_SHINGLES:
            yield ItemIndex(ids, bags, widths)
            ids, bags, widths, held = [], [], [], 0
    if ids:
        yield ItemIndex(ids, bags, widths)


HIT = "doc_id long, item_id long, similarity double, start_word long, n_shingles long, distance int"


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per (document, benchmark item found in it): the similarity of
    the matching window, its first word and its length in shingles."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    out = docs.sparkSession.createDataFrame([], HIT)
    for index in item_blocks(benchmark):
        out = out.unionAll(rows.mapInArrow(_searcher(docs.sparkSession.sparkContext.broadcast(index)), HIT))
    by_doc = ["doc_id", "item_id"]
    return out.groupBy(*by_doc).agg(
        F.min(F.struct("distance", "start_word", "n_shingles", "similarity")).alias("hit")).select(
        *by_doc, "hit.similarity", "hit.start_word", "hit.n_shingles", "hit.distance")


def _searcher(index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(i, *hit) for i, words in enumerate(texts_words(batch.column(1)))
                     for hit in search(words, index.value)]
            if found:
                row, item, score, start, length, distance = zip(*found)
                yield pa.RecordBatch.from_arrays(
                    [pc.take(batch.column(0), pa.array(row)), pa.array(item, pa.int64()), pa.array(score, pa.float64()),
                     pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                     pa.array(distance, pa.int32())],
                    ["doc_id", "item_id", "similarity", "start_word", "n_shingles", "distance"])
    return run


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; decided row by
    row, so the documents are neither shuffled nor read twice."""
    where = docs.columns.index(text_col)
    for index in item_blocks(benchmark):
        docs = docs.mapInArrow(_filter(docs.sparkSession.sparkContext.broadcast(index), where), docs.schema)
    return docs


def _filter(index, where: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([not search(w, index.value) for w in texts_words(batch.column(where))], pa.bool_()))
    return run
