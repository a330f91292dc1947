"""Toxicity by subword-bag embeddings and a linear softmax, trained in numpy.

A word is a run of letters and digits (lower-cased); its subwords are the
character n-grams of 3 to 6 bytes of ``<word>``, hashed into buckets with one
embedding each. A text window of ``WINDOW`` words is the average of all its
subword embeddings, and a linear softmax over that average gives its toxicity;
embeddings and softmax are trained jointly, so a misspelt or inflected word
that was never seen shares most of its vectors with the words it comes from.

A document scores as its most toxic window, so a long clean text does not
dilute an insult. Training follows that rule: after a few epochs on the
averages of whole documents, each epoch picks every document's highest window
under the current model and trains on the picks (multiple-instance learning).

The classifier is fitted on a bounded sample of labelled rows: at most
``SAMPLE_TOXIC`` toxic and ``SAMPLE_CLEAN`` clean documents, the ones with the
smallest hash of their id; all documents are scored, over their whole text.
Only the projection of each bucket on the softmax (``BUCKETS`` floats) is
broadcast, a fixed size.

Defined cases: null or empty text scores as an empty window; a null id is not
held out and not learned from; null labels are ignored, and of a document
labelled more than once it is toxic if any label says so; of texts that share a
labelled id the one with the smallest hash is learned from; without labelled
rows every score is 0; repeated rows score alike; an empty table gives an
empty result; other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.words import SLICE_BYTES, mix, row_slices, span_hashes, text_buffer, word_spans

WINDOW = 8
BUCKETS = 1 << 17
DIM = 8
NGRAMS = (3, 4, 5, 6)
SAMPLE_TOXIC = 4000
SAMPLE_CLEAN = 6000
HELD_OUT_MOD, HELD_OUT_REST = 5, 0
STEP_WORDS = 1 << 16  # words of a step on whole documents
DOC_EPOCHS = 6
WINDOW_EPOCHS = 20
RATE = 0.5
CLEAN_WEIGHT = 2.0
SEED = 7

# Separators: every ASCII byte that is neither letter nor digit.
_GAP = np.ones(256, bool)
_GAP[128:] = False
for _a, _b in ((48, 58), (65, 91), (97, 123)):
    _GAP[_a:_b] = False
_NGRAM_WEIGHT = mix(np.arange(16, dtype=np.uint64) + np.uint64(0xC0FFEE)) | np.uint64(1)


def held_out(id_col: Column) -> Column:
    rest = F.crc32(id_col.cast("string").cast("binary")) % HELD_OUT_MOD
    return F.coalesce(rest == HELD_OUT_REST, F.lit(False))


def _lowered(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return text_buffer(pc.utf8_lower(column.cast(pa.large_string()).fill_null("")))


def subwords(raw: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of each word, word by word, and how many each
    has (one at least: ``<x>`` has three characters)."""
    done, parts, counts, i = np.cumsum(lengths + 2), [], [], 0
    while i < len(starts):  # in slices of words
        j = max(i + 1, int(np.searchsorted(done, (done[i - 1] if i else 0) + SLICE_BYTES // 4)))
        bucket, count = _word_grams(raw, starts[i:j], lengths[i:j])
        parts.append(bucket)
        counts.append(count)
        i = j
    if not parts:
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    return np.concatenate(parts), np.concatenate(counts)


def _word_grams(raw: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    size = lengths + 2
    first = np.cumsum(size) - size
    marked = np.empty(int(size.sum()), np.uint64)
    at = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    marked[np.repeat(first + 1, lengths) + at] = raw[np.repeat(starts, lengths) + at]
    marked[first] = 1
    marked[first + size - 1] = 2
    word = np.repeat(np.arange(len(size), dtype=np.int32), size)
    room = np.repeat(first + size, size) - np.arange(len(marked))  # bytes up to the word's end
    buckets, owner = [], []
    for n in NGRAMS:
        ok = np.flatnonzero(room >= n)
        total = np.full(len(ok), np.uint64(n))
        for k in range(n):
            total += marked[ok + k] * _NGRAM_WEIGHT[k]
        buckets.append(((mix(total) >> np.uint64(40)) & np.uint64(BUCKETS - 1)).astype(np.int32))
        owner.append(word[ok])
    buckets, owner = np.concatenate(buckets), np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return buckets[order], np.bincount(owner, minlength=len(size)).astype(np.int32)


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of ``values`` (rows of a matrix too), each
    ``counts`` long, one at least."""
    return np.add.reduceat(values, np.cumsum(counts) - counts, axis=0)


def _windows(words_per_doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words in each window, document by document, and windows per document."""
    per_doc = -(-words_per_doc // WINDOW)
    size = np.full(int(per_doc.sum()), WINDOW)
    last = np.cumsum(per_doc)[per_doc > 0] - 1
    size[last] = words_per_doc[per_doc > 0] - (per_doc[per_doc > 0] - 1) * WINDOW
    return size, per_doc


class _Adagrad:
    def __init__(self, *shapes):
        self.seen = [np.full(s, 1e-6, np.float32) for s in shapes]

    def step(self, i: int, value: np.ndarray, grad: np.ndarray, rows=slice(None)) -> None:
        self.seen[i][rows] += grad * grad
        value[rows] -= RATE * grad / np.sqrt(self.seen[i][rows])


class _Words:
    """The words of a sample: one number per occurrence, and the n-gram buckets
    of each distinct word once. Texts go by in slices and are not kept."""

    def __init__(self):
        self.hashes, self.numbers = np.zeros(0, np.uint64), np.zeros(0, np.int32)  # of distinct words, by hash
        self.words, self.counts, self.buckets, self.grams = [], [], [], []

    def add(self, column: pa.Array) -> None:
        for _, _, raw, starts, lengths, bounds in _text_slices(column):
            self.counts.append(np.diff(bounds))
            if not len(starts):
                continue
            distinct, first, word = np.unique(span_hashes(raw, starts, lengths, lower=False), return_index=True, return_inverse=True)
            place = np.searchsorted(self.hashes, distinct)
            known = np.zeros(len(distinct), bool)
            known[place < len(self.hashes)] = self.hashes[place[place < len(self.hashes)]] == distinct[place < len(self.hashes)]
            number = np.empty(len(distinct), np.int32)
            number[known] = self.numbers[place[known]]
            number[~known] = len(self.hashes) + np.arange((~known).sum())
            bucket, grams = subwords(raw, starts[first[~known]], lengths[first[~known]])
            self.buckets.append(bucket)
            self.grams.append(grams)
            self.hashes = np.insert(self.hashes, place[~known], distinct[~known])
            self.numbers = np.insert(self.numbers, place[~known], number[~known])
            self.words.append(number[word])


def _joined(parts: list[np.ndarray], kind) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def train(texts: pa.Array | list[str | None], toxic: np.ndarray) -> tuple[np.ndarray, float]:
    """Fit embeddings and softmax; returns what each bucket adds to the log
    odds of toxic (before averaging) and the bias."""
    words = _Words()
    words.add(texts if isinstance(texts, (pa.Array, pa.ChunkedArray)) else pa.array(texts, pa.large_string()))
    return _train(words, toxic)


def _train(words: _Words, toxic: np.ndarray) -> tuple[np.ndarray, float]:
    word, words_per_doc = _joined(words.words, np.int32), _joined(words.counts, np.int64)
    if not len(word):
        return np.zeros(BUCKETS, np.float32), -20.0
    bucket, grams = _joined(words.buckets, np.int32), _joined(words.grams, np.int32)
    at = np.cumsum(grams, dtype=np.int64) - grams
    bounds = np.append(0, np.cumsum(words_per_doc))

    rng = np.random.default_rng(SEED)
    emb = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    soft, bias = rng.uniform(-1, 1, (DIM, 2)).astype(np.float32), np.zeros(2, np.float32)
    opt = _Adagrad(emb.shape, soft.shape, bias.shape)

    def fit(begin: np.ndarray, count: np.ndarray, label: np.ndarray, weight: np.ndarray) -> None:
        """One joint step on averages over runs of words (first, count). Each
        distinct word of the step is looked up once."""
        run = np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        distinct, back = np.unique(word[run], return_inverse=True)
        g = grams[distinct]
        idx = bucket[np.repeat(at[distinct] - (np.cumsum(g) - g), g) + np.arange(int(g.sum()))]
        vector = _sums(emb[idx], g)
        some = count > 0
        per = _sums(g[back].astype(float), count[some])
        x = np.zeros((len(begin), DIM), np.float32)
        x[some] = _sums(vector[back], count[some]) / per[:, None]
        z = x @ soft + bias
        z -= z.max(1, keepdims=True)
        p = np.exp(z)
        p /= p.sum(1, keepdims=True)
        p[np.arange(len(label)), label] -= 1
        p *= (weight / weight.sum())[:, None]
        dx = p @ soft.T
        dx[some] /= per[:, None]
        owner = np.repeat(np.arange(len(count)), count)
        rows, of_row = np.unique(idx, return_inverse=True)
        grad = np.empty((len(rows), DIM))
        for k in range(DIM):
            of_word = np.bincount(back, dx[owner, k], len(distinct))
            grad[:, k] = np.bincount(of_row, np.repeat(of_word, g), len(rows))
        opt.step(0, emb, grad, rows)
        opt.step(1, soft, x.T @ p)
        opt.step(2, bias, p.sum(0))

    label = toxic.astype(np.int64)
    weight = np.where(label == 1, 1.0, CLEAN_WEIGHT * max(1, (label == 1).sum()) / max(1, (label == 0).sum()))
    docs = np.flatnonzero(words_per_doc > 0)
    for _ in range(DOC_EPOCHS):
        order = rng.permutation(docs)
        step = np.cumsum(words_per_doc[order]) // STEP_WORDS  # steps of some documents, one at least
        for part in np.split(order, np.flatnonzero(np.diff(step)) + 1):
            fit(bounds[:-1][part], words_per_doc[part], label[part], weight[part])

    size, per_doc = _windows(words_per_doc)
    begin = np.cumsum(size) - size
    first_window = (np.cumsum(per_doc) - per_doc)[docs]
    doc_of = np.repeat(np.arange(len(docs), dtype=np.int32), per_doc[docs])
    weight_of = _sums(grams[word].astype(np.float32), size)
    for _ in range(WINDOW_EPOCHS):
        gain = _sums((emb @ (soft[:, 1] - soft[:, 0]))[bucket], grams)
        score = _sums(gain[word], size) / weight_of
        order = np.lexsort((score, doc_of))
        best = order[np.append(first_window[1:], len(order)) - 1]
        clean = docs[label[docs] == 0]
        other = first_window[label[docs] == 0] + (rng.random(len(clean)) * per_doc[clean]).astype(int)
        pick = np.concatenate([best, other])
        lab = np.concatenate([label[docs], np.zeros(len(other), np.int64)])
        wei = np.concatenate([weight[docs], weight[clean] / 2])
        for part in np.array_split(rng.permutation(len(pick)), max(1, len(pick) // 1024)):
            part_begin = np.append(begin[pick[part]], 0)
            part_size = np.append(size[pick[part]], 0)  # and an empty window, clean
            fit(part_begin, part_size, np.append(lab[part], 0), np.append(wei[part], 1.0))
    return (emb @ (soft[:, 1] - soft[:, 0])).astype(np.float32), float(bias[1] - bias[0])


def _text_slices(column: pa.Array) -> Iterator[tuple]:
    """Rows of a column in slices of bounded size (one text at least): first
    and end row, lower-cased bytes, and starts, lengths and row bounds of the words."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets = text_buffer(column)
    for i, j in row_slices(_, offsets):
        raw, off = _lowered(column.slice(i, j - i))
        starts, lengths, bounds = word_spans(raw, off, _GAP)
        yield i, j, raw, starts, lengths, bounds


def window_scores(column: pa.Array, gain: np.ndarray, bias: float) -> np.ndarray:
    """Highest window probability of each text of a column."""
    out = np.full(len(column), bias)
    for i, j, raw, starts, lengths, bounds in _text_slices(column):
        if not len(starts):
            continue
        _, first, word = np.unique(span_hashes(raw, starts, lengths, lower=False), return_index=True, return_inverse=True)
        bucket, grams = subwords(raw, starts[first], lengths[first])
        size, per_doc = _windows(np.diff(bounds))
        score = _sums(_sums(gain[bucket], grams)[word], size) / _sums(grams[word].astype(float), size)
        some = per_doc > 0
        out[i:j][some] = np.maximum.reduceat(score, (np.cumsum(per_doc) - per_doc)[some]) + bias
    return 1 / (1 + np.exp(-np.clip(out, -50, 50)))


def _fit_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words, toxic = _Words(), []
    for batch in batches:  # the bounded sample, in order of its ids; texts are let go
        words.add(batch.column(1))
        toxic.append(batch.column(2).to_numpy())
    if not sum(map(len, toxic)):
        return
    gain, bias = _train(words, np.concatenate(toxic))
    yield pa.RecordBatch.from_arrays([pa.array([gain.tobytes()], pa.binary()), pa.array([bias])], ["gain", "bias"])


def fit_model(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              label_id: str = "doc_id", label_col: str = "toxic") -> tuple[np.ndarray, float] | None:
    """The model learned from labelled rows that are not held out."""
    known = (labels.where(F.col(label_col).isNotNull() & F.col(label_id).isNotNull() & ~held_out(F.col(label_id)))
             .groupBy(F.col(label_id).alias("doc_id")).agg(F.max((F.col(label_col) == 1).cast("int")).alias("toxic")))
    by_hash = [F.xxhash64("doc_id"), F.col("doc_id")]
    sample = (known.where("toxic = 1").orderBy(*by_hash).limit(SAMPLE_TOXIC)
              .unionAll(known.where("toxic = 0").orderBy(*by_hash).limit(SAMPLE_CLEAN)))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    # At most SAMPLE_TOXIC + SAMPLE_CLEAN narrow rows: a proven bound.
    first = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"), "text")
    rows = (texts.join(F.broadcast(sample), "doc_id").withColumn("rank", F.row_number().over(first)).where("rank = 1")
            .select("doc_id", "text", "toxic"))
    # One task, in one order: the same model whatever way the rows were dealt.
    found = rows.repartition(1).sortWithinPartitions("doc_id").mapInArrow(_fit_task, "gain binary, bias double").collect()
    if not found:
        return None
    return np.frombuffer(found[0]["gain"], np.float32), found[0]["bias"]


def score_documents(docs: DataFrame, model: tuple[np.ndarray, float] | None, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """doc_id, score, predicted (1 from a score of 0.5 on) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if shared.value is None:
                score = np.zeros(len(batch))
            else:
                score = window_scores(batch.column(1), *shared.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                ["doc_id", "score", "predicted"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double, predicted int")


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows predicted toxic, all columns kept."""
    model = fit_model(docs, labels, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    where = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if shared.value is None:
                yield batch
            else:
                yield batch.filter(pa.array(window_scores(batch.column(where), *shared.value) < 0.5))

    return docs.mapInArrow(run, docs.schema)
