"""Self-join of documents on word 5-gram Jaccard similarity, size-aware.

Exact heavy-light method. All shingles get one global order, rarest first. A
set of n shingles that is 0.8-similar to another shares at least
o = ceil(0.8 n) of its shingles with it, so any two similar sets share c
shingles within their first n - o + c ones:

* *light* sets (n up to a boundary) enumerate all subsets of fixed size c = 2
  of that prefix, and two light sets meet under an equal subset;
* *heavy* sets post their prefix (c = 1) into inverted lists, which they scan
  for all sets, light ones near the boundary included.

The boundary minimises keys to enumerate plus lists to scan over the measured
histogram of set sizes. The order only steers cost, so it may come from
partial counts: each task counts the shingles it sees twice or more, the
counts are summed over the corpus and the ``HEAVY_TABLE`` most frequent ones
rank last (a table of fixed size); results do not depend on it.

Copies collapse first: equal sets form one class, and only classes are joined.
Long lists are not expanded into all pairs: every member is first verified
against the list's leader, links give components, and later rounds pair only
members whose components still differ (a part of the partners first, then
all), so every link between different components is found while pairs that
cannot change a component are never made. Candidates whose posted keys cannot
reach the needed overlap go, the rest are verified on whole sets.

Defined cases: null or empty text: empty set, linked with nothing; fewer than
five words: the whole sequence is the one shingle; null ids take part and
never become a component's id unless it holds no other; rows repeated whole
give repeated result rows; an empty table gives an empty result. Shingles are
compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.shared import arrow_batches, components, salted_join, stored
from salesmart.llm.words import mix, texts_shingles

HEAVY_TABLE = 1 << 17   # most frequent shingles with a rank of their own
COUNT_FLUSH = 1 << 21   # shingles a task counts together
TEXT_BATCH = "4m"       # bytes of texts handed to a Python task at a time
SHORT_LIST = 8          # lists up to this long are paired at once
PARTNER_SHARES = (32, 8, 1)  # later rounds: one partner in 32, in 8, then all
LARGEST_LIGHT = 256     # sizes tried as the boundary
SIZE_BINS = 4096
BROADCAST_IDS = 1 << 20  # ids sent to every executor at most

_SETS_SCHEMA = "kind int, doc_id long, n int, cid long, shingle long, seen long"


def needed(n: np.ndarray | int):
    """ceil(0.8 n): shared shingles any similar partner implies."""
    return -(-4 * n // 5)


def _class_of(shingles: np.ndarray) -> int:
    """64-bit identity of a shingle set."""
    h = mix(shingles)
    folded = np.array([h.sum(dtype=np.uint64), np.bitwise_xor.reduce(mix(h)), np.uint64(len(h))], np.uint64)
    return int(mix(np.array([mix(folded).sum(dtype=np.uint64)], np.uint64)).view(np.int64)[0])


def _seen_often(shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that stand twice or more in an array, which is sorted in place,
    and how often; beside it only those take memory."""
    shingles.sort()
    same = np.append(shingles[1:] == shingles[:-1], False)  # as the next one
    first = np.flatnonzero(same & ~np.append(False, same[:-1]))
    last = np.flatnonzero(~same & np.append(False, same[:-1]))
    return shingles[first], last - first + 1


def _document_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document its set's size and class (kind 0); shingles seen in two
    sets or more of this task, each class counted once (kind 1)."""
    held, size, classes = np.empty(COUNT_FLUSH, np.uint64), 0, set()

    def counted(shingles: np.ndarray) -> pa.RecordBatch:
        shingle, seen = _seen_often(shingles)
        none = pa.nulls(len(shingle), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(np.ones(len(shingle), np.int32)), none, pa.nulls(len(shingle), pa.int32()), none,
             pa.array(shingle.view(np.int64)), pa.array(seen.astype(np.int64))], _NAMES)

    for batch in batches:
        n, cid = np.zeros(len(batch), np.int32), np.zeros(len(batch), np.int64)
        for i, found in enumerate(texts_shingles(batch.column(1))):
            shingles = np.unique(found)
            n[i] = len(shingles)
            if not len(shingles):
                continue
            cid[i] = _class_of(shingles)
            if cid[i] in classes:
                continue
            classes.add(cid[i])
            while len(shingles):
                some = shingles[:COUNT_FLUSH - size]
                held[size:size + len(some)] = some
                shingles, size = shingles[len(some):], size + len(some)
                if size == COUNT_FLUSH:
                    yield counted(held)
                    size = 0
        none = pa.nulls(len(batch), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.zeros(len(batch), np.int32)), batch.column(0).cast(pa.int64()), pa.array(n),
             pa.array(cid), none, none], _NAMES)
    if size:
        yield counted(held[:size])


_NAMES = ["kind", "doc_id", "n", "cid", "shingle", "seen"]


def boundary(sizes: dict[int, int], scan_cost: float) -> int:
    """The set size up to which enumerating 2-subsets is cheaper, in total,
    than posting into lists that have to be scanned."""
    def prefix(n):
        return n - needed(n) + 1

    best, best_cost = 3, None
    for b in range(3, LARGEST_LIGHT + 1):
        cost = 0.0
        for n, count in sizes.items():
            if n < 4:
                continue
            if n <= b:
                q = prefix(n) + 1
                cost += count * q * (q - 1) / 2
            if n > b or 5 * n >= 4 * (b + 1):
                cost += count * prefix(n) * scan_cost
        if best_cost is None or cost < best_cost:
            best, best_cost = b, cost
    return best


def _postings(heavy_shingle: np.ndarray, heavy_rank: np.ndarray, light: int):
    """mapInArrow function: keys of each class's prefix. Odd keys are lists,
    even ones 2-subsets; ``ub`` is the overlap two sets can still have when
    this key is the first one they share."""
    def keys(shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(shingles)
        rank = np.zeros(n, np.int64)
        if len(heavy_shingle):
            at = np.minimum(np.searchsorted(heavy_shingle, shingles), len(heavy_shingle) - 1)
            known = heavy_shingle[at] == shingles
            rank[known] = heavy_rank[at[known]]
        first = n - needed(n) + 2
        order = np.lexsort((shingles, rank))[:first]
        token = shingles[order]
        out, ub = [], []
        if n <= light:
            i, j = np.triu_indices(len(token), 1)
            out.append(mix(token[i] * np.uint64(0x9E3779B97F4A7C15) + token[j]) & ~np.uint64(1))
            ub.append(n - j + 1)
        if n > light or 5 * n >= 4 * (light + 1):
            single = token[: first - 1]
            out.append(single | np.uint64(1))
            ub.append(n - np.arange(len(single)))
        return np.concatenate(out), np.concatenate(ub)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = set()
        for batch in batches:
            key, cid, n, ub, rows = [], [], [], [], 0
            for found in texts_shingles(batch.column(0)):
                shingles = np.unique(found)
                if len(shingles) < 4:
                    continue  # no different set can be similar
                c = _class_of(shingles)
                if c in classes:
                    continue
                classes.add(c)
                k, u = keys(shingles)
                key.append(k)
                ub.append(u)
                cid.append(np.full(len(k), c, np.int64))
                n.append(np.full(len(k), len(shingles), np.int32))
                rows += len(k)
                if rows >= 1 << 17:
                    yield _posting_batch(key, cid, n, ub)
                    key, cid, n, ub, rows = [], [], [], [], 0
            if rows:
                yield _posting_batch(key, cid, n, ub)

    return run


def _posting_batch(key, cid, n, ub) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(key).view(np.int64)), pa.array(np.concatenate(cid)), pa.array(np.concatenate(n)),
         pa.array(np.concatenate(ub).astype(np.int32))], ["key", "cid", "n", "ub"])


def _class_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cid, sets, rows = [], [], 0
        for found in texts_shingles(batch.column(0)):
            shingles = np.unique(found)
            if len(shingles) >= 4:
                cid.append(_class_of(shingles))
                sets.append(shingles.view(np.int64))
                rows += len(shingles)
            if rows >= 1 << 18:
                yield _set_batch(cid, sets)
                cid, sets, rows = [], [], 0
        if cid:
            yield _set_batch(cid, sets)


def _set_batch(cid: list[int], sets: list[np.ndarray]) -> pa.RecordBatch:
    offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [pa.array(cid, pa.int64()), pa.array(np.diff(offsets)),
         pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(sets))),
         pa.array([_bitmap(s.view(np.uint64)) for s in sets], pa.binary())], ["cid", "n", "items", "bits"])


def _bitmap(shingles: np.ndarray) -> bytes:
    """One bit per shingle in a map of eight to sixteen bits each, a power of
    two long: two maps that differ in k bits have sets that differ in k."""
    size = 64 << max(0, int(len(shingles) - 1).bit_length() - 3)
    bits = np.zeros(size, np.uint8)
    bits[(shingles & np.uint64(size - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def _differing_bits(a: bytes, b: bytes) -> int:
    a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    while len(a) > len(b):  # folding a map gives that of half the size
        a = a[: len(a) // 2] | a[len(a) // 2:]
    while len(b) > len(a):
        b = b[: len(b) // 2] | b[len(b) // 2:]
    return int(np.bitwise_count(a ^ b).sum())


def _close_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose maps allow a Jaccard of 0.8: at most a ninth of both sizes
    differs."""
    for batch in batches:
        near = [9 * _differing_bits(x, y) <= n + m for n, m, x, y in zip(*(c.to_pylist() for c in batch.columns[2:6]))]
        yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))


def _may_link(a: str, b: str):
    """Length and position filters of a pair met under one key."""
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    enough = F.least(F.col(f"{a}.ub"), F.col(f"{b}.ub")) * 9 >= (na + nb) * 4
    return (F.least(na, nb) * 5 >= F.greatest(na, nb) * 4) & enough


def _pairs(joined: DataFrame, light: int) -> DataFrame:
    """Distinct candidate pairs of a self-join aliased x, y; in a list at
    least one set is heavy (two light ones meet under their subsets)."""
    met = _may_link("x", "y") & ((F.col("x.key") % 2 == 0) | (F.greatest("x.n", "y.n") > light))
    return (joined.where(met & (F.col("x.cid") != F.col("y.cid")))
            .select(F.least("x.cid", "y.cid").alias("a"), F.greatest("x.cid", "y.cid").alias("b")).distinct())


def _both_sides(pairs: DataFrame, table: DataFrame, value: str) -> DataFrame:
    """``pairs`` (a, b) with n and ``value`` of both classes (n_a, n_b, of_a,
    of_b) from ``table``. The row of a class with many partners is repeated
    once per 256 of them, so a hub is dealt over many tasks."""
    many = F.least(F.ceil(F.count("*").over(Window.partitionBy("a")) / 256), F.lit(4096)).cast("int")
    dealt = pairs.withColumn("pieces", many).withColumn("piece", F.pmod(F.xxhash64("b"), F.col("pieces")).cast("int"))
    hubs = (dealt.groupBy("a").agg(F.max("pieces").alias("pieces"))
            .join(table.select(F.col("cid").alias("a"), F.col("n").alias("n_a"), F.col(value).alias("of_a")), "a")
            .withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))).drop("pieces"))
    spokes = table.select(F.col("cid").alias("b"), F.col("n").alias("n_b"), F.col(value).alias("of_b"))
    return dealt.join(spokes, "b").join(hubs, ["a", "piece"]).select("a", "b", "n_a", "n_b", "of_a", "of_b")


def _common():
    return F.size(F.array_intersect("of_a", "of_b"))


def _plausible(pairs: DataFrame, posted: DataFrame, light: int) -> DataFrame:
    """Pairs that the list keys both sets posted still allow: the shared ones
    and all that lies beyond the prefix must reach the needed overlap."""
    def beyond(n: str):
        return F.ceil(F.col(n) * 4 / 5) - 1

    reach = (_common() + F.greatest(beyond("n_a"), beyond("n_b"))) * 9 >= (F.col("n_a") + F.col("n_b")) * 4
    return _both_sides(pairs, posted, "items").where((F.greatest("n_a", "n_b") <= light) | reach).select("a", "b")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (a, b) with ``linked``: exact Jaccard of the whole sets, after
    their bit maps (an eighth of the size or so) have excluded most others."""
    near = stored(_both_sides(pairs, sets, "bits").mapInArrow(_close_bits, "a long, b long"), "near-pairs")
    common = _common()
    exact = _both_sides(near, sets, "items").where(
        common * 100 >= (F.col("n_a") + F.col("n_b") - common) * 80).select("a", "b", F.lit(True).alias("linked"))
    return pairs.join(exact, ["a", "b"], "left").select("a", "b", F.coalesce("linked", F.lit(False)).alias("linked"))


def linked_classes(lists: DataFrame, sets_of: Callable[[DataFrame], DataFrame], light: int) -> DataFrame:
    """(node, component) of classes that link to another one. ``sets_of``
    gives the shingle sets of the classes (cid) it is asked for."""
    per_key = Window.partitionBy("key")
    lists = stored(lists.withColumn("m", F.count("*").over(per_key)).withColumn(
        "leader", F.min(F.struct("cid", "n", "ub")).over(per_key)), "lists")
    posted = stored(lists.groupBy("cid").agg(F.max("n").alias("n"), F.collect_list(
        F.when(F.col("key") % 2 != 0, F.col("key"))).alias("items")), "posted")

    def tested_pairs(pairs: DataFrame) -> DataFrame:
        pairs = stored(_plausible(stored(pairs, "candidates"), posted, light), "pairs")
        sets = sets_of(pairs.select(F.col("a").alias("cid")).unionAll(pairs.select("b")).distinct())
        return stored(_verified(pairs, sets), "tested")

    x, y = lists.alias("x"), lists.alias("y")
    short = x.where("m <= %d" % SHORT_LIST).join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.cid") < F.col("y.cid")))
    star = lists.where("m > %d" % SHORT_LIST).select(
        F.struct("key", "cid", "n", "ub").alias("x"), F.struct(F.col("key"), "leader.*").alias("y"))
    tested = tested_pairs(_pairs(short, light).unionAll(_pairs(star, light)).distinct())
    labels = components(tested.where("linked"))

    for share in PARTNER_SHARES:
        long = lists.where("m > %d" % SHORT_LIST).select("key", "cid", "n", "ub").join(
            labels, F.col("cid") == F.col("node"), "left").withColumn("label", F.coalesce("component", "cid"))
        long = stored(long.drop("node", "component"), "long-lists")
        counts = long.groupBy("key", "label").agg(F.count("*").alias("c"))
        major = (counts.groupBy("key").agg(F.count("*").alias("labels"), F.max(F.struct("c", "label")).alias("top"))
                 .where("labels > 1").select("key", F.col("top.label").alias("major")))
        minority = stored(long.join(major, "key").where("label <> major").drop("major"), "minority")
        if minority.isEmpty():
            break  # no list holds two components any more
        partners = long.where(F.pmod(F.xxhash64("cid"), F.lit(share)) == 0)
        met = minority.alias("x").join(partners.alias("y"), (F.col("x.key") == F.col("y.key"))
                                       & (F.col("x.label") != F.col("y.label")))
        result = tested_pairs(_pairs(met, light).join(tested.select("a", "b"), ["a", "b"], "left_anti"))
        tested = tested.unionAll(result)
        if not result.where("linked").isEmpty():
            labels = components(tested.where("linked"))
    return labels


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest
    id reachable by links of Jaccard 0.8 or more, itself included)."""
    with arrow_batches(docs.sparkSession, TEXT_BATCH):  # all Python tasks run in here
        return _near_duplicates(docs, id_col, text_col)


def _near_duplicates(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = stored(rows.mapInArrow(_document_sets, _SETS_SCHEMA), "sets")
    members = found.where("kind = 0").select("doc_id", "n", "cid")
    classes = stored(members.where("n > 0").groupBy("cid").agg(
        F.min("doc_id").alias("rep"), F.max("n").alias("n"), F.count("*").alias("copies")), "classes")

    top = (found.where("kind = 1").groupBy("shingle").agg(F.sum("seen").alias("seen"))
           .orderBy(F.desc("seen"), "shingle").limit(HEAVY_TABLE).toPandas())
    shingle = top["shingle"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(shingle)
    seen = top["seen"].to_numpy(np.float64)
    sizes = {r["bin"]: r["count"] for r in
             classes.groupBy(F.least("n", F.lit(SIZE_BINS)).alias("bin")).count().collect()}
    total = max(1, sum(n * c for n, c in sizes.items()))
    light = boundary(sizes, 1 + min(3.0, 0.04 * float((seen ** 2).sum()) / total))

    heavy = docs.sparkSession.sparkContext.broadcast((shingle[order], top["seen"].to_numpy(np.int64)[order]))
    postings = rows.select("text").mapInArrow(_bound(heavy, light), "key long, cid long, n int, ub int")
    per_key = Window.partitionBy("key")
    lists = stored(postings.withColumn("lo", F.min("cid").over(per_key)).withColumn("hi", F.max("cid").over(per_key))
                   .where("lo <> hi").select("key", "cid", "n", "ub").distinct(), "shared-keys")

    def sets_of(wanted: DataFrame) -> DataFrame:
        wanted = stored(wanted, "wanted")
        reps = stored(classes.join(wanted, "cid", "left_semi").select(F.col("rep").alias("_rep")), "representatives")
        if reps.count() <= BROADCAST_IDS:  # else the texts are shuffled to them
            reps = F.broadcast(reps)
        texts = rows.join(reps, F.col("doc_id").eqNullSafe(F.col("_rep")), "left_semi").select("text")
        # An id that is repeated may bring a class twice: it verifies alike.
        return stored(texts.mapInArrow(_class_sets, "cid long, n int, items array<long>, bits binary"), "class-sets")

    labels = linked_classes(lists, sets_of, light)
    comps = classes.join(labels, F.col("cid") == F.col("node"), "left").select(
        "cid", "rep", F.coalesce("component", "cid").alias("component"))
    least = comps.groupBy("component").agg(F.min("rep").alias("component_id"))
    of_class = stored(comps.join(least, "component").select("cid", "component_id"), "class-components")
    full = salted_join(members.where("n > 0"), of_class, ["cid"], ["doc_id"])
    return full.select("doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id").unionByName(
        members.where("n = 0").select("doc_id", F.lit(0).cast("long").alias("n_shingles"),
                                      F.col("doc_id").alias("component_id")))


def _bound(heavy, light: int):
    """The postings function with its table taken from the broadcast."""
    def run(batches):
        yield from _postings(heavy.value[0], heavy.value[1], light)(batches)
    return run
