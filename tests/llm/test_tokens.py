"""Simple-8b segments and token files against plain versions of both."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from public_tokenizers import path as tokenizer_path
from salesmart.llm import simple8b as s8
from salesmart.llm import token_files as tf
from salesmart.llm.queries import QUERIES
from salesmart.session import new_run_dir
from tests.conftest import SF01

FILE = tokenizer_path("byte_bpe_50k.json")
PLAIN = Tokenizer.from_file(FILE)
ENCODER = tf.PieceEncoder(FILE)  # remembers pieces from one example to the next


def plain_words(values):
    """Greedy packing word by word, block by block."""
    words, escapes, first = [], [], []
    for b in range(0, len(values), s8.BLOCK):
        block, i = values[b:b + s8.BLOCK], 0
        first.append(len(words))
        while i < len(block):
            for s in range(1, s8.LAST + 1):
                part = block[i:i + int(s8.COUNTS[s])]
                if all(v < 1 << int(s8.BITS[s]) for v in part):
                    words.append(s << 60 | sum(v << (int(s8.BITS[s]) * k) for k, v in enumerate(part)))
                    i += len(part)
                    break
            else:
                words.append(len(escapes))
                escapes.append(block[i])
                i += 1
    return words, first, escapes


sizes = st.sampled_from([1, 2, 7, 8, 15, 16, 20, 21, 30, 31, 59, 60, 61, 64])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(sizes, st.integers(0, 2 ** 64 - 1), st.integers(1, 70)), max_size=60))
def test_words_are_those_of_greedy_packing(runs):
    values = [v >> (64 - bits) for bits, v, n in runs for _ in range(n)]
    words, first, escapes = s8.encode(np.array(values, np.uint64))
    want = plain_words(values)
    assert (words.tolist(), first.tolist(), escapes.tolist()) == want
    assert s8.decode(words, first, escapes, len(values)).tolist() == values


def test_segments_decode_any_range():
    rng = np.random.default_rng(3)
    ids = rng.integers(0, 1 << rng.integers(1, 63, 5000), dtype=np.int64).astype(np.uint64)
    data = s8.Segment(7, 3, np.array([4, 9]), np.array([0, 4], np.uint8), np.array([1200, 3800]), ids).to_bytes()
    view = s8.SegmentView(data)
    for a, b in ((0, 5000), (0, 1), (511, 513), (512, 1024), (4999, 5000), (1200, 5000), (3, 3)):
        assert (view.ids(a, b) == ids[a:b]).all()
    assert (view.first_id, view.first_doc, view.counts.tolist()) == (7, 3, [1200, 3800])
    with pytest.raises(ValueError):
        s8.SegmentView(b"XXXX" + data[4:])
    with pytest.raises(ValueError):
        s8.SegmentView(data + b"\0")
    empty = s8.SegmentView(s8.Segment(0, 0, np.zeros(0), np.zeros(0), np.zeros(0), np.zeros(0)).to_bytes())
    assert not len(empty.ids())


PIECES = st.sampled_from([" ", "  ", "\n", "\t\r\n", " ", "　", " ", "a", "it's", "'s", "été", "日本語", "12", "!?", "<|endoftext|>",
                          "\x1c", "​", "\U0001F600", "x" * 40, " the"])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(PIECES, max_size=30).map("".join), max_size=8))
def test_pieces_give_the_ids_of_whole_texts(texts):
    ids, counts = ENCODER.encode(pa.array(texts, pa.string()))
    want = [e.ids for e in PLAIN.encode_batch(texts, add_special_tokens=False)]
    assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_a_full_memory_changes_nothing(monkeypatch):
    monkeypatch.setattr(tf, "KNOWN", 5)
    encoder = tf.PieceEncoder(FILE)
    for texts in (["a b c d e f g a b"], ["h a i b", "", "a" * 100], ["a b h i"]):
        ids, _ = encoder.encode(pa.array(texts))
        assert ids.tolist() == [i for t in texts for i in PLAIN.encode(t, add_special_tokens=False).ids]
    assert len(encoder.known) == 5


@given(st.binary(max_size=50), st.binary(max_size=50))
def test_crc_of_a_concatenation(a, b):
    assert tf.crc_of_both(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


def brute(rows):
    """(doc_id, n_tokens, ids_crc32, start) of (doc_id, text) rows in order."""
    start, out = 0, []
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array(PLAIN.encode(text or "", add_special_tokens=False).ids + [tf.END_ID], "<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_query_matches_encoding_each_text(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()]
    got = QUERIES["op12_token_files"](spark, SF01).collect()
    assert sorted(map(tuple, got)) == brute(rows)


@pytest.mark.parametrize("segment_ids", [1, 700, 5000, 1 << 20])
def test_segments_of_every_length(spark, documents, no_documents, segment_ids):
    path = new_run_dir(spark, "test-tokens")
    frame, rows = documents
    if segment_ids == 1:  # every document longer than one id is cut, the end id alone
        rows = [r for r in rows if len(r[1] or "") < 60]
        frame = frame.where("text is null or length(text) < 60")
    tf.write_token_files(frame, path, FILE, segment_ids=segment_ids)
    assert sorted(map(tuple, tf.read_documents(spark, path).collect())) == brute([r[:2] for r in rows])
    seen = spark.read.parquet(path).groupBy("part").agg({"n_ids": "min", "seg": "max"}).collect()
    assert all(r["min(n_ids)"] <= segment_ids for r in seen)
    path = new_run_dir(spark, "test-tokens")
    tf.write_token_files(no_documents, path, FILE)
    assert tf.read_documents(spark, path).isEmpty()


def test_repeated_rows_and_null_ids(spark):
    rows = [(3, "same text")] * 50 + [(None, "no id"), (None, None), (3, None), (1, ""), (2, "a  \n b")]
    path = new_run_dir(spark, "test-tokens")
    tf.write_token_files(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), path, FILE, segment_ids=40)
    got = tf.read_documents(spark, path).orderBy("start").collect()
    want = brute(rows)
    assert sorted((r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in got) == sorted((w[0] or 0, *w[2:]) for w in want)
    ids = [r.doc_id for r in got]
    assert ids == [None, None, 1, 2] + [3] * 51
    assert [r.start for r in got] == np.append(0, np.cumsum([r.n_tokens for r in got]))[:-1].tolist()


MARKS = st.sampled_from(["a", "don", "'t", "'", "'re", "'S", ".", ",", "...", "!", "-", "_", "(", ")", "1", "é", "×", " ", "\n", " (", "<|endoftext|>",
                         "<|endoftext", "|>", "<|", "\x7f", "https://a.b/c?d=e", "　", "\U0001F600"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(MARKS, max_size=25).map("".join), max_size=8))
def test_punctuation_behind_words_gives_the_ids_of_whole_texts(texts):
    ids, counts = ENCODER.encode(pa.array(texts, pa.string()))
    want = [e.ids for e in PLAIN.encode_batch(texts, add_special_tokens=False)]
    assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_a_word_is_encoded_once_whatever_mark_follows(monkeypatch):
    encoder, seen = tf.PieceEncoder(FILE), []
    plain = encoder._encode
    monkeypatch.setattr(encoder, "_encode", lambda texts: (seen.extend(texts), plain(texts))[1])
    texts = [f"Some word{a} another word{b} the end{c}" for a in ".,;:!?)" for b in ".,;:!?)" for c in ".,;:!?)"]
    ids, _ = encoder.encode(pa.array(texts))
    assert ids.tolist() == [i for t in texts for i in PLAIN.encode(t, add_special_tokens=False).ids]
    assert sum(text.count("word") for text in seen) == 1


def test_slices_join_small_batches():
    batches = [pa.RecordBatch.from_arrays([pa.array([i]), pa.array(["x" * n])], ["doc_id", "text"])
               for i, n in enumerate([1 << 20] * 20 + [20 << 20, 5])]
    got = list(tf._slices(iter(batches)))
    assert pa.Table.from_batches(got).equals(pa.Table.from_batches(batches).combine_chunks())
    assert [len(b) for b in got] == [8, 8, 5, 1] and not list(tf._slices(iter([])))
