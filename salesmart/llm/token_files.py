"""Token ids of a corpus as Simple-8b segments, written and read by Spark.

Documents are range-partitioned by id, so the parts of a data set, and the rows
of each part, are in ascending order of ``doc_id``. Every task tokenises its
rows, appends the end id to each, and cuts the stream of ids into segments of
``SEGMENT_IDS`` ids (the last one shorter), whatever documents they belong to:
a very long text spans several. A row of the written table is one segment in
the format of :mod:`salesmart.llm.simple8b`; Spark's commit protocol makes a
retried task harmless. The number of ids before a part comes from one row per
part, so nothing but those counts is ever brought together.

A text is cut before every run of white space, and where an ASCII letter is
followed by an ASCII punctuation mark. No token of the byte-level BPE crosses
such a place, so a slice of texts encodes each distinct piece once and puts its
ids wherever the piece stands; the result is that of encoding the whole text,
which the tests compare. (Texts that hold one of the tokenizer's added tokens,
which may contain punctuation, are cut at white space only.) A worker remembers the ids of up to ``KNOWN`` short
pieces for its later slices; what is encoded anew or taken from there makes no
difference to the result. Texts with white space beyond ASCII are encoded whole.

Defined cases: a null text is empty and has the end id alone; a null id comes
first, equal ids stand in order of a hash of their texts; rows repeated whole
are each written; an empty table gives no segment and an empty result; other
columns are not read.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesmart.llm.shared import arrow_batches, stored
from salesmart.llm.simple8b import GOES_ON_FROM, GOES_ON_IN, NULL_ID, Segment, SegmentView
from salesmart.llm.words import text_buffer

END_ID = 2
SEGMENT_IDS = 1 << 20
SLICE = 8 << 20  # bytes of rows tokenised together, the batch that reaches it included
TEXT_BATCH = "2m"  # bytes of rows handed to a task at a time (one text at least)
PIECES = 1 << 13  # bytes of pieces in one call of the tokenizer
KNOWN, KNOWN_BYTES = 1 << 19, 32  # pieces that a worker remembers, and their length
# White space that the tokenizer's rules know beyond the six ASCII characters
# (and some that other rules count as such).
_OTHER_SPACE = "[\x1c-\x1f\u0085\u00a0\u1680\u180e\u2000-\u200f\u2028\u2029\u202f\u205f\u2060\u3000\ufeff]"
_KIND = np.zeros(256, np.uint8)
_SPACE, _LETTER, _MARK = 1, 2, 3
_KIND[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = _SPACE
_KIND[[i for i in range(128) if chr(i).isalpha()]] = _LETTER
_KIND[[i for i in range(0x21, 0x7F) if not chr(i).isalnum()]] = _MARK


class PieceEncoder:
    """Whole-text ids of many texts, each distinct piece encoded once."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one thread a task
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.length = np.zeros(max(vocabulary.values()) + 1, np.int64)  # bytes of each token
        for token, i in vocabulary.items():
            self.length[i] = len(token)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known = pa.array([], pa.large_string())
        self.known_ids, self.known_counts = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _pieces(self, pieces: pa.LargeStringArray, joins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces, one after the other, and how many each has.
        ``joins``: pieces that may follow another one in one call."""
        raw, at = text_buffer(pieces)
        size = np.diff(at)
        counts = np.zeros(len(size), np.int64)
        group = np.cumsum(np.append(True, ~(joins[1:] & joins[:-1]))[:len(size)]) if len(size) else np.zeros(0, np.int64)
        call = group * (1 << 40) + at[:-1] // PIECES  # consecutive joining pieces, some thousand bytes
        first = np.flatnonzero(np.append(True, call[1:] != call[:-1])[:len(size)])
        ends = np.append(first[1:], len(size))
        texts = [raw[at[i]:at[j]].tobytes().decode() for i, j in zip(first, ends)]
        found = [np.array(ids, np.int64) for ids in self._encode(texts)]
        for i, j, ids in zip(first, ends, found):
            if j - i == 1:
                counts[i] = len(ids)
                continue
            ends_at, want = np.cumsum(self.length[ids]), at[i + 1:j + 1] - at[i]
            upto = np.searchsorted(ends_at, want, "left") + 1
            if upto[-1] != len(ids) or (ends_at[upto - 1] != want).any():
                raise ValueError("a token crosses white space: not a byte-level BPE that splits there")
            counts[i:j] = np.diff(upto, prepend=0)
        return (np.concatenate(found) if found else np.zeros(0, np.int64)), counts

    def _of_pieces(self, pieces: pa.LargeStringArray, joins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and where those of each piece begin and how many they are."""
        place = pc.index_in(pieces, value_set=self.known).fill_null(-1).to_numpy()
        new = np.flatnonzero(place < 0)
        place = np.where(place < 0, 0, place)
        place[new] = len(self.known) + np.arange(len(new))
        fresh = pieces.take(pa.array(new))
        new_ids, new_counts = self._pieces(fresh, joins[new])
        ids, counts = np.concatenate([self.known_ids, new_ids.astype(np.uint32)]), np.append(self.known_counts, new_counts)
        first = np.cumsum(counts) - counts
        short = pc.less_equal(pc.binary_length(fresh), KNOWN_BYTES).to_numpy(zero_copy_only=False).astype(bool)
        add = np.flatnonzero(short)[:KNOWN - len(self.known)]
        if len(add):
            at, n = first[len(self.known):][add], new_counts[add]
            ahead = np.cumsum(n) - n
            self.known_ids = np.append(self.known_ids, ids[np.repeat(at - ahead, n) + np.arange(int(n.sum()))])
            self.known_counts = np.append(self.known_counts, n)
            self.known = pa.concat_arrays([self.known, fresh.take(pa.array(add))])
        return ids, first[place], counts[place]

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts of a column, one after the other, and how many
        each text has."""
        column = column.cast(pa.large_string()).fill_null("")
        odd = pc.match_substring_regex(column, _OTHER_SPACE).to_numpy(zero_copy_only=False).astype(bool)
        raw, offsets = text_buffer(column)
        kind = _KIND[raw]
        space, begins = kind == _SPACE, np.zeros(len(raw) + 1, bool)
        begins[1:-1] = (kind[1:] == _MARK) & (kind[:-1] == _LETTER)
        for token in self.added:  # found before a text is split
            holds = pc.match_substring(column, token).to_numpy(zero_copy_only=False).astype(bool)
            for i in np.flatnonzero(holds):
                begins[offsets[i]:offsets[i + 1]] = False
        begins[1:-1] |= space[1:] & ~space[:-1]
        for i in np.flatnonzero(odd):
            begins[offsets[i]:offsets[i + 1]] = False
        begins[offsets] = True
        cut = np.flatnonzero(begins)
        all_pieces = pa.LargeStringArray.from_buffers(len(cut) - 1, pa.py_buffer(cut.astype(np.int64)), pa.py_buffer(raw.tobytes()))
        coded = all_pieces.dictionary_encode()
        index = coded.indices.to_numpy()
        # Pieces " word" may stand beside each other in a call; others (the
        # first of a text, punctuation, trailing white space, whole odd texts)
        # stand alone.
        sole = np.zeros(len(coded.dictionary), bool)
        opens = space[cut[:-1]] & ~space[cut[1:] - 1] if len(cut) > 1 else np.zeros(0, bool)
        if odd.any():
            opens &= ~odd[np.searchsorted(offsets, cut[:-1], "right") - 1]
        sole[index[~opens]] = True
        ids, first, counts = self._of_pieces(coded.dictionary, ~sole)
        per = counts[index]
        ahead = np.append(0, np.cumsum(per))
        small = np.int32 if len(ids) + ahead[-1] < 1 << 31 else np.int64  # positions
        out = ids[np.repeat((first[index] - ahead[:-1]).astype(small), per) + np.arange(ahead[-1], dtype=small)]
        return out, np.diff(ahead[np.searchsorted(cut, offsets)])


_ENCODERS: dict[str, PieceEncoder] = {}  # one per Python worker


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches joined up to about ``SLICE`` bytes."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= SLICE:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def _writer(path: str, segment_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _ENCODERS:
            _ENCODERS[path] = PieceEncoder(path)
        part, seg, first_id, first_doc, open_before = TaskContext.get().partitionId(), 0, 0, 0, False
        held_ids, held_docs, held_null, held_counts, held = [], [], [], [], 0

        def cut(n: int) -> pa.RecordBatch:
            """A segment of the next ``n`` ids held."""
            nonlocal seg, first_id, first_doc, open_before, held_ids, held_docs, held_null, held_counts, held
            ids, docs = np.concatenate(held_ids), np.concatenate(held_docs)
            null, counts = np.concatenate(held_null), np.concatenate(held_counts)
            upto = np.cumsum(counts)
            k = int(np.searchsorted(upto, n))  # the document of the last id
            here = counts[:k + 1].copy()
            here[k] -= upto[k] - n
            goes_on = bool(upto[k] > n)
            flags = null[:k + 1] * NULL_ID
            flags[0] |= GOES_ON_FROM * open_before
            flags[k] |= GOES_ON_IN * goes_on
            data = Segment(first_id, first_doc, docs[:k + 1], flags, here, ids[:n]).to_bytes()
            out = pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seg], pa.int32()), pa.array([n], pa.int64()), pa.array([data], pa.large_binary())],
                ["part", "seg", "n_ids", "segment"])
            drop = k if goes_on else k + 1
            held_ids, held_docs, held_null = [ids[n:]], [docs[drop:]], [null[drop:]]
            rest = counts[drop:].copy()
            if goes_on:
                rest[0] = upto[k] - n
            held_counts, held = [rest], held - n
            seg, first_id, first_doc, open_before = seg + 1, first_id + n, first_doc + drop, goes_on
            return out

        for some in _slices(batches):
            doc_ids = some.column(0)
            ids, counts = _ENCODERS[path].encode(some.column(1))
            ends = np.cumsum(counts)
            held_ids.append(np.insert(ids, ends, END_ID))
            held_counts.append(counts + 1)
            held_docs.append(doc_ids.fill_null(0).to_numpy())
            held_null.append(doc_ids.is_null().to_numpy(zero_copy_only=False).astype(np.uint8))
            held += len(held_ids[-1])
            while held >= segment_ids:
                yield cut(segment_ids)
        if held:
            yield cut(held)

    return run


def write_token_files(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                      segment_ids: int = SEGMENT_IDS) -> None:
    """Write the ids of ``docs`` in ascending order of their id to ``path``, as
    segments in order of (part, seg). ``tokenizer`` is a file of the tokenizers
    library that every executor can open."""
    text = F.col(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("by_text"),
                       F.monotonically_increasing_id().alias("row"))
    keys = ["doc_id", "by_text", "row"]  # with the row, copies of one row can be dealt over many tasks
    with arrow_batches(docs.sparkSession, TEXT_BATCH):
        (rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text")
         .mapInArrow(_writer(tokenizer, segment_ids), "part int, seg int, n_ids long, segment binary")
         .write.option("compression", "none").parquet(path))  # words are packed already


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, seg, data in zip(*[batch.column(c).to_pylist() for c in ("part", "seg", "segment")]):
            view = SegmentView(data)
            ids = view.ids().astype("<u4")
            bounds = np.append(0, np.cumsum(view.counts))
            crc = [zlib.crc32(ids[a:b].data) for a, b in zip(bounds[:-1], bounds[1:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(crc), part, np.int32)), pa.array(np.full(len(crc), seg, np.int32)),
                 pa.array(view.first_doc + np.arange(len(crc))),
                 pa.array(view.doc_ids, mask=(view.flags & NULL_ID).astype(bool)),
                 pa.array(view.first_id + bounds[:-1]), pa.array(view.counts), pa.array(crc, pa.int64()),
                 pa.array((view.flags & (GOES_ON_FROM | GOES_ON_IN)) == 0)],
                ["part", "seg", "doc", "doc_id", "at", "n", "crc", "whole"])


# CRC-32 of a concatenation: the first one's register is moved on by the second
# one's length, a multiplication by a power of x modulo the polynomial.
_POLY = 0xEDB88320


def _times(a: int, b: int) -> int:
    """Product of two reflected polynomials modulo the CRC's."""
    out = 0
    for bit in range(31, -1, -1):
        if a >> bit & 1:
            out ^= b
        b = (b >> 1) ^ (_POLY if b & 1 else 0)
    return out


def crc_of_both(first: int, second: int, second_bytes: int) -> int:
    """CRC-32 of two byte strings together, from theirs."""
    power, by, n = 1 << 31, 1 << 23, second_bytes  # 1, and x to the 8th
    while n:
        if n & 1:
            power = _times(power, by)
        by, n = _times(by, by), n >> 1
    return _times(power, first) ^ second


def _joined_crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        crcs = []
        for pieces in batch.column("pieces").to_pylist():
            crc = 0
            for piece in pieces:
                crc = crc_of_both(crc, piece["crc"], 4 * piece["n"])
            crcs.append(crc)
        yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("part", "doc_id", "at", "n")] + [pa.array(crcs, pa.int64())],
                                         ["part", "doc_id", "at", "n", "crc"])


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the files under ``path``: doc_id, start,
    n_tokens and ids_crc32 (of its ids as little-endian 32-bit integers)."""
    segments = spark.read.schema("part int, seg int, n_ids long, segment binary").parquet(path)
    pieces = stored(segments.select("part", "seg", "segment").mapInArrow(
        _documents, "part int, seg int, doc long, doc_id long, at long, n long, crc long, whole boolean"), "token-pieces")
    columns = ["part", "doc_id", "at", "n", "crc"]
    # Documents cut by the end of a segment: as many pieces as segments.
    split = (pieces.where("not whole").groupBy("part", "doc")
             .agg(F.max("doc_id").alias("doc_id"), F.min("at").alias("at"), F.sum("n").alias("n"),
                  F.array_sort(F.collect_list(F.struct("seg", "n", "crc"))).alias("pieces"))
             .select("part", "doc_id", "at", "n", "pieces")
             .mapInArrow(_joined_crc, "part int, doc_id long, at long, n long, crc long"))
    found = pieces.where("whole").select(*columns).unionByName(split)
    sizes = segments.groupBy("part").agg(F.sum("n_ids").alias("ids"))  # one row per part
    before = F.sum("ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    bases = sizes.select("part", F.coalesce(before, F.lit(0)).alias("base"))
    return (found.join(bases, "part")
            .select("doc_id", (F.col("base") + F.col("at")).alias("start"), F.col("n").alias("n_tokens"),
                    F.col("crc").alias("ids_crc32")))
