"""Mixing sources to target weights by entropy balancing.

Sizes are words. Sources in code-point order (null last) weigh 5, 2, 1,
repeating, and share ``BUDGET`` times all words; a source's target stops at
``CAP`` times its size and the excess is shared among the others by weight
until none is above (the common level of the rest has a closed form).

Within a source the document rates are those closest in entropy to "each
document once" that meet the source's token constraint, with no rate above
``CAP``: rate = CAP / (1 + exp(-lambda * size / mean size)), an exponential
tilt in the document's size. Each source's lambda minimises the convex dual.
All sources are solved together by safeguarded Newton iterations, each one a
distributed aggregate over (source, size) cells, which hold all documents
exactly because a rate depends on source and size alone. The state has one row
per source and is written after every iteration.

Rates become whole copies cell by cell, from large sizes to small, carrying
the words still owed, and single copies are then exchanged while that brings
the source nearer to its target. Which documents of a cell get the extra copy goes by the
hash of their id; ranks within a cell are counted in 64 buckets, so a cell
with a third of all rows is never sorted in one task. Reruns agree.

Defined cases: null text is empty, size 0, and takes nothing; a source of
size 0 has target 0; null is a source of its own; rows repeated whole are
documents of their own; an empty table gives an empty result; other columns
are not read. One task handles one source's cells: distinct sizes, at most
the square root of twice its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.shared import stored
from salesmart.llm.words import row_slices, text_buffer, word_spans

WEIGHTS = (5.0, 2.0, 1.0)
BUDGET = 1.5
CAP = 2.0
TOLERANCE = 1e-6
MAX_ITERATIONS = 60
HALVINGS = 200
BUCKETS = 64
SETTLE_STEPS = 50


def word_counts(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """doc_id, source, size of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_buffer(batch.column(2))
            size = np.zeros(len(batch), np.int64)
            for i, j in row_slices(raw, offsets):
                size[i:j] = np.diff(word_spans(raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])[2])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(size)], ["doc_id", "source", "size"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                       F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, source string, size long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """One row per source: key (its rank), source, documents, source_size,
    target. The windows run over one row per source."""
    by_source = sizes.groupBy("source").agg(F.count("*").alias("documents"), F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source"))
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), ((F.col("key") - 1) % len(WEIGHTS) + 1).cast("int"))
    keyed = by_source.withColumn("key", rank).withColumn("weight", weight).withColumn("cap", F.col("source_size") * CAP)
    before = Window.orderBy(F.col("cap") / F.col("weight"), "key").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # What the sources not yet stopped would share per unit of weight, were
    # those before (in order of cap / weight) stopped: it peaks at the answer.
    level = ((F.sum("source_size").over(every) * BUDGET - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
             / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    return (keyed.withColumn("level", level).withColumn("peak", F.max("level").over(every))
            .select("key", "source", "documents", "source_size",
                    F.least(F.col("cap"), F.col("weight") * F.col("peak")).alias("target")))


def _rate(size, lam, mean):
    return F.lit(CAP) / (1 + F.exp(F.greatest(F.lit(-700.0), F.least(F.lit(700.0), -lam * size / mean))))


def solve(cells: DataFrame, targets: DataFrame) -> DataFrame:
    """The dual variable of each source below its cap: (key, lam, mean). After
    ``MAX_ITERATIONS`` Newton steps the bracket is halved until a source is
    settled or its bracket holds no other double; else it raises."""
    state = stored(targets.where(f"source_size > 0 and target < source_size * {CAP} * (1 - 1e-12)").select(
        "key", "target", (F.col("source_size") / F.col("documents")).alias("mean"), F.lit(0.0).alias("lam"),
        F.lit(None).cast("double").alias("lo"), F.lit(None).cast("double").alias("hi"),
        F.lit(None).cast("double").alias("miss")), "mix-state")
    for step in range(MAX_ITERATIONS + HALVINGS):
        rate = _rate(F.col("size"), F.col("lam"), F.col("mean"))
        words = F.col("n") * F.col("size")
        sums = (cells.join(state.select("key", "lam", "mean"), "key").groupBy("key")
                .agg(F.sum(words * rate).alias("has"),
                     F.sum(words * rate * (1 - rate / CAP) * F.col("size") / F.col("mean")).alias("slope")))
        gap = F.col("has") - F.col("target")
        lo, hi = F.when(gap < 0, F.col("lam")).otherwise(F.col("lo")), F.when(gap > 0, F.col("lam")).otherwise(F.col("hi"))
        most = 2 + 2 * F.abs("lam")
        newton = F.coalesce(F.greatest(-most, F.least(most, -gap / F.nullif(F.col("slope"), F.lit(0.0)))),
                            F.when(gap < 0, most).otherwise(-most)) + F.col("lam")
        outside = F.col("new_lo").isNotNull() & F.col("new_hi").isNotNull() & (
            (F.col("newton") <= F.col("new_lo")) | (F.col("newton") >= F.col("new_hi")) | F.lit(step >= MAX_ITERATIONS))
        state = stored(
            state.join(sums, "key").withColumn("new_lo", lo).withColumn("new_hi", hi).withColumn("newton", newton)
            .withColumn("now", F.abs(gap) / F.greatest(F.col("target"), F.lit(1.0)))
            .select("key", "target", "mean",
                    F.when(F.col("now") <= TOLERANCE, F.col("lam"))
                    .when(outside, (F.col("new_lo") + F.col("new_hi")) / 2).otherwise(F.col("newton")).alias("lam"),
                    F.col("new_lo").alias("lo"), F.col("new_hi").alias("hi"), F.col("now").alias("miss")), "mix-state")
        unsettled = state.where(F.col("miss") > TOLERANCE).where(
            "lo is null or hi is null or ((lo + hi) / 2 > lo and (lo + hi) / 2 < hi)")
        if unsettled.isEmpty():
            return state.select("key", "lam", "mean")
    keys = [r["key"] for r in unsettled.select("key").orderBy("key").limit(10).collect()]
    raise RuntimeError(f"no tilt found for the sources numbered {keys}")


def _settle(n: np.ndarray, size: np.ndarray, copies: np.ndarray, owed: float) -> None:
    """Moves the cells' ``copies`` (0 to CAP for each of n documents) nearer to
    the words still ``owed``: one copy more, one less, or one more against one
    less, as long as that helps."""
    order = np.argsort(size, kind="stable")
    order = order[size[order] > 0]
    for _ in range(SETTLE_STEPS):
        more = order[copies[order] < CAP * n[order]]
        less = order[copies[order] > 0]
        up, down = np.append(size[more], 0), np.insert(size[less], 0, 0)  # 0: no such move
        best = (abs(owed) - 1e-9, -1, -1)
        at = np.searchsorted(down, up - owed)
        for j in (np.clip(at - 1, 0, len(down) - 1), np.clip(at, 0, len(down) - 1)):
            miss = np.abs(owed - (up - down[j]))
            i = int(miss.argmin())
            best = min(best, (float(miss[i]), i, int(j[i])))
        _, i, j = best
        if i < 0:
            return
        owed -= float(up[i] - down[j])
        if i < len(more):
            copies[more[i]] += 1
        if j:
            copies[less[j - 1]] -= 1


def _round_source(cells: pd.DataFrame) -> pd.DataFrame:
    """Copies of each cell: ``base`` for all its documents and one more for
    ``extra`` of them, sizes from large to small, words owed carried on."""
    cells = cells.sort_values("size", ascending=False)
    n, size, rate = (cells[c].to_numpy() for c in ("n", "size", "rate"))
    base = np.floor(rate).astype(np.int64)
    owed = float(cells["target"].iloc[0]) - float((n * rate * size).sum())
    extra = np.zeros(len(cells), np.int64)
    for k in range(len(cells)):
        if not size[k] or base[k] >= CAP:
            continue
        want = n[k] * (rate[k] - base[k])
        extra[k] = min(n[k], max(0, round(want + owed / size[k])))
        owed += (want - extra[k]) * size[k]
    copies = base * n + extra
    _settle(n, size, copies, owed)
    return pd.DataFrame({"key": cells["key"], "size": size, "base": copies // n, "extra": copies % n})


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per document: doc_id, size, source_size, target (its source's),
    copies, taken (words the mix takes of it)."""
    sizes = stored(word_counts(docs, id_col, text_col, source_col), "mix-sizes")
    targets = stored(source_targets(sizes), "mix-targets")
    keyed = stored(sizes.join(targets.select("source", "key"), sizes["source"].eqNullSafe(targets["source"]))
                   .select("doc_id", "key", "size",
                           F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(BUCKETS)).alias("bucket")), "mix-documents")
    counts = stored(keyed.groupBy("key", "size", "bucket").agg(F.count("*").alias("n")), "mix-cells")
    cells = counts.groupBy("key", "size").agg(F.sum("n").alias("n"))
    solved = solve(cells, targets)
    rated = (cells.join(targets.select("key", "target"), "key").join(solved, "key", "left")
             .withColumn("rate", F.when(F.col("lam").isNull(), F.lit(CAP))
                         .otherwise(_rate(F.col("size"), F.col("lam"), F.col("mean")))))
    copies = rated.groupBy("key").applyInPandas(_round_source, "key int, size long, base long, extra long")
    earlier = Window.partitionBy("key", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).join(copies, ["key", "size"])
    rank = F.row_number().over(Window.partitionBy("key", "size", "bucket").orderBy(F.xxhash64("doc_id"), "doc_id"))
    taken = (keyed.withColumn("rank", rank).join(offsets.drop("n"), ["key", "size", "bucket"])
             .withColumn("copies", F.col("base") + (F.col("rank") + F.col("before") <= F.col("extra")).cast("long")))
    return taken.join(targets.select("key", "source_size", "target"), "key").select(
        "doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mix_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: every document once per copy, with the copy's number in
    ``copy`` (underscores in front where that name is taken). Rows that share
    an id get the same number of copies, the most of theirs."""
    number = "copy"
    while number in docs.columns:
        number = f"_{number}"
    copies = mixed(docs, id_col, text_col, source_col).groupBy(F.col("doc_id").alias("__mix_id")).agg(
        F.max("copies").alias("__mix_copies")).where("__mix_copies > 0")
    return docs.join(copies, docs[id_col].eqNullSafe(copies["__mix_id"])).select(
        *[docs[c] for c in docs.columns], F.explode(F.sequence(F.lit(1).cast("long"), F.col("__mix_copies"))).alias(number))
