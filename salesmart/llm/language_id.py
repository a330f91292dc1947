"""Language identification with hyperdimensional profiles.

Every letter has a random vector of ``DIM`` signs, derived from its code point.
An n-gram (three symbols; a run of other characters is one gap symbol) is the
bound product of its letters' vectors, each permuted by its place: rotated by
two, one and no steps. A text is the bundle (sum) of its n-gram vectors, a
language's prototype the bundle of all its training texts, and a text is given
to the prototype with the largest cosine, after the mean of all prototypes is
taken out of both, since what all languages share says nothing.

Signs are kept as bits, so binding is exclusive-or and permuting a rotation;
bundles are integer sums, the same however the work is split. Only the
prototypes, one vector per label, are gathered and broadcast.

Learned only from text and non-null label of rows that are not held out;
label, source and id never take part in a prediction. Defined cases: a text
that is null or has no letter is ``und`` with score 0, as is every text when
nothing was learned; ties go to the first label in code-point order; repeated
rows are predicted alike; a null id is not held out; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.words import mix, row_slices, text_buffer

DIM = 1024
GRAM_BLOCK = 4096   # distinct n-grams turned into vectors at a time
ROW_BLOCK = 256     # texts bundled at a time
HELD_OUT_MOD, HELD_OUT_REST = 3, 1
UNKNOWN = "und"
_WORDS = DIM // 64


def held_out(id_col: Column) -> Column:
    rest = F.crc32(id_col.cast("string").cast("binary")) % HELD_OUT_MOD
    return F.coalesce(rest == HELD_OUT_REST, F.lit(False))


def letter_vectors(points: np.ndarray) -> np.ndarray:
    """The random sign vector of each code point, as bits (n x DIM / 64)."""
    return mix(mix(points.astype(np.uint64))[:, None] + np.arange(_WORDS, dtype=np.uint64)[None, :])


def _rotated(bits: np.ndarray, steps: int) -> np.ndarray:
    """Bit vectors rotated by ``steps`` places over their whole length."""
    high = np.roll(bits, 1, axis=1) >> np.uint64(64 - steps)
    return (bits << np.uint64(steps)) | high


def gram_vectors(grams: np.ndarray) -> np.ndarray:
    """+1 / -1 vectors of three-symbol n-grams (n x 3 code points, 0 = gap)."""
    points, back = np.unique(grams, return_inverse=True)
    letters, back = letter_vectors(points), back.reshape(grams.shape)
    bound = _rotated(letters, 2)[back[:, 0]] ^ _rotated(letters, 1)[back[:, 1]] ^ letters[back[:, 2]]
    return np.unpackbits(bound.view(np.uint8), axis=1, bitorder="little").astype(np.float32) * 2 - 1


class Symbols:
    """Numbers the symbols met so far: 0 is the gap, letters follow."""

    def __init__(self):
        self.number = np.full(0x110000, -1, np.int32)
        self.points = np.zeros(1, np.int64)
        self.is_letter = np.zeros(1, bool)  # marks count as symbols, not as letters

    def of(self, points: np.ndarray) -> np.ndarray:
        symbol = self.number[points]
        if (symbol < 0).any():
            new = np.unique(points[symbol < 0])
            kind = np.array([unicodedata.category(chr(p))[0] for p in new.tolist()])
            symbol_too = (kind == "L") | (kind == "M")
            self.number[new[~symbol_too]] = 0
            self.number[new[symbol_too]] = len(self.points) + np.arange(int(symbol_too.sum()))
            self.points = np.append(self.points, new[symbol_too])
            self.is_letter = np.append(self.is_letter, kind[symbol_too] == "L")
            symbol = self.number[points]
        return symbol


def grams_of(column: pa.Array, symbols: Symbols) -> Iterator[tuple]:
    """(first row, end, whether each row has a letter, row, gram index,
    distinct grams) by slices of rows; row and gram index have one entry per
    n-gram."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    raw_all, off_all = text_buffer(pc.utf8_lower(column.cast(pa.large_string()).fill_null("")))
    for i, j in row_slices(raw_all, off_all):
        raw = raw_all[off_all[i]:off_all[j]]
        points = np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), np.uint32)
        chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])[off_all[i:j + 1] - off_all[i]]
        row = np.repeat(np.arange(j - i), np.diff(chars))
        symbol = symbols.of(points)
        # A gap before and after every text, and one for every run of others.
        symbol = np.insert(symbol, chars[:-1], 0)
        row = np.insert(row, chars[:-1], np.arange(j - i))
        symbol, row = np.append(symbol, 0), np.append(row, j - i)
        keep = symbol > 0
        keep[1:] |= symbol[:-1] > 0
        keep[0] = True
        symbol, row = symbol[keep].astype(np.int64), row[keep]
        lettered = np.bincount(row[symbols.is_letter[symbol]], minlength=j - i) > 0
        if len(symbol) < 3:
            yield i, j, lettered, np.zeros(0, int), np.zeros(0, int), np.zeros((0, 3), np.int64)
            continue
        k = len(symbols.points)
        code = (symbol[:-2] * k + symbol[1:-1]) * k + symbol[2:]
        # The middle symbol is a letter, or the gap between two words of a text.
        inside = (symbol[1:-1] > 0) | ((symbol[:-2] > 0) & (symbol[2:] > 0) & (row[:-2] == row[2:]))
        code, owner = code[inside], row[:-2][inside]
        owner = np.where(symbol[:-2][inside] > 0, owner, row[1:-1][inside])
        if k ** 3 <= 1 << 21:
            found = np.flatnonzero(np.bincount(code, minlength=1))
            where = np.zeros(k ** 3, np.int32)
            where[found] = np.arange(len(found))
            index = where[code]
        else:
            found, index = np.unique(code, return_inverse=True)
        grams = np.stack([found // (k * k), found // k % k, found % k], 1)
        yield i, j, lettered, owner, index, symbols.points[grams]


def bundles(rows: np.ndarray, index: np.ndarray, grams: np.ndarray, n: int) -> np.ndarray:
    """Sum of the n-gram vectors of each of ``n`` rows (n x DIM)."""
    out = np.zeros((n, DIM), np.float64)
    order = np.argsort(rows, kind="stable") if len(rows) and (np.diff(rows) < 0).any() else slice(None)
    rows, index = rows[order], index[order]
    for g in range(0, len(grams), GRAM_BLOCK):
        vectors = gram_vectors(grams[g:g + GRAM_BLOCK])
        here = (index >= g) & (index < g + GRAM_BLOCK)
        r, c = rows[here], index[here] - g
        for a in range(0, n, ROW_BLOCK):
            lo, hi = np.searchsorted(r, [a, a + ROW_BLOCK])
            if lo == hi:
                continue
            size = min(ROW_BLOCK, n - a)
            count = np.bincount((r[lo:hi] - a) * len(vectors) + c[lo:hi], minlength=size * len(vectors))
            out[a:a + size] += count.reshape(size, len(vectors)).astype(np.float32) @ vectors
    return out


def _learn_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each label's bundle over the task's texts, one row per dimension."""
    symbols, total = Symbols(), {}
    for batch in batches:
        label = batch.column(1).to_pylist()
        for i, j, _, rows, index, grams in grams_of(batch.column(0), symbols):
            names = sorted(set(label[i:j]))
            number = {name: k for k, name in enumerate(names)}
            of_row = np.array([number[x] for x in label[i:j]])
            sums = bundles(of_row[rows], index, grams, len(names))
            for name, k in number.items():
                total[name] = total.get(name, 0) + np.rint(sums[k]).astype(np.int64)
    for name, vector in sorted(total.items()):
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * DIM), pa.array(np.arange(DIM, dtype=np.int32)), pa.array(vector)], ["label", "dim", "value"])


def learn(rows: DataFrame) -> tuple[list[str], np.ndarray]:
    """Labels and their prototypes from (text, label) rows, labels not null."""
    sums = rows.select("text", "label").mapInArrow(_learn_task, "label string, dim int, value long")
    table = sums.groupBy("label", "dim").agg(F.sum("value").alias("value")).toPandas()
    labels = sorted(set(table["label"]))
    vectors = np.zeros((len(labels), DIM))
    at = {name: k for k, name in enumerate(labels)}
    vectors[table["label"].map(at).to_numpy(int) if len(table) else [], table["dim"].to_numpy(int)] = table["value"].to_numpy(float)
    return labels, vectors


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)


def classify(column: pa.Array, symbols: Symbols, labels: list[str], prototypes: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Label and score, (1 + cosine) / 2, of each text of a column."""
    best, score = [UNKNOWN] * len(column), np.zeros(len(column))
    if not labels:
        return best, score
    known = _unit(prototypes)
    mean = known.mean(0) if len(labels) > 1 else np.zeros(DIM)
    known = _unit(known - mean)
    for i, j, some, rows, index, grams in grams_of(column, symbols):
        texts = bundles(rows, index, grams, j - i)
        cosine = _unit(_unit(texts) - mean) @ known.T
        for r in np.flatnonzero(some):
            k = int(cosine[r].argmax())
            best[i + r], score[i + r] = labels[k], min(1.0, max(0.0, (1 + cosine[r, k]) / 2))
    return best, score


def predict_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang") -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       F.col(label_col).alias("label"))
    learned = learn(rows.where(F.col("label").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))))
    model = docs.sparkSession.sparkContext.broadcast(learned)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols = Symbols()
        for batch in batches:
            best, score = classify(batch.column(1), symbols, *model.value)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(best, pa.string()), pa.array(score)],
                                             ["doc_id", "lang_pred", "score"])

    found = rows.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
