import random

import numpy as np

from salesmart.llm.decontaminate import (RADIUS, ItemIndex, _bit_votes, contaminated, distances, drop_contaminated,
                                         fingerprints, similarity)
from tests.llm import brute
from tests.llm.conftest import prose


def _case(spark):
    rng = random.Random(5)
    items = [(k, prose(rng, n, "b")) for k, n in enumerate((3, 5, 12, 20, 45, 60))] + [(6, None), (7, ""), (8, prose(rng, 25, "b"))]
    items.append((9, items[4][1]))  # equal items are each reported
    docs = []
    for k, (_, item) in enumerate(items):
        if not item:
            continue
        around = prose(rng, 50), prose(rng, 30)
        changed = item.split()
        changed[len(changed) // 2] = "edited"
        docs += [f"{around[0]} {item.upper()} {around[1]}", f"{item}\n{around[0]}", " ".join(changed),
                 around[0] + " " + " ".join(item.split()[: max(1, len(item.split()) // 2)])]
    docs += [None, "", "b1", prose(rng, 400, "b"), prose(rng, 20_000) + " " + items[3][1]]
    return items, list(enumerate(docs))


def test_finds_what_brute_force_finds(spark):
    items, docs = _case(spark)
    bench = spark.createDataFrame([(k, t, "x") for k, t in items], "item_id long, text string, doc_id string")
    frame = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, item_id string")
    got = contaminated(frame, bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == brute.contained(docs, [(k, t) for k, t in items if t])
    assert all(0.8 <= r.similarity <= 1 and r.distance <= RADIUS for r in got)
    dirty = {r.doc_id for r in got}
    kept = drop_contaminated(frame, bench)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == [i for i, _ in docs if i not in dirty]


def test_blocks_of_items_find_the_same(spark, monkeypatch):
    import salesmart.llm.decontaminate as module
    items, docs = _case(spark)
    bench = spark.createDataFrame(items, "item_id long, text string")
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    once = {(r.doc_id, r.item_id) for r in contaminated(frame, bench).collect()}
    monkeypatch.setattr(module, "ITEM_BLOCK", 2)
    assert {(r.doc_id, r.item_id) for r in contaminated(frame, bench).collect()} == once


def test_index_finds_every_fingerprint_within_the_radius():
    rng = np.random.default_rng(1)
    bags = [rng.integers(0, 1 << 63, 40, dtype=np.uint64) for _ in range(60)]
    index = ItemIndex(list(range(60)), bags, [5] * 60)
    prints = []
    for k in range(60):  # fingerprints at known distances from an item
        bits = np.unpackbits(index.prints[k].view(np.uint8))
        flip = rng.choice(128, k % 55, replace=False)
        bits[flip] ^= 1
        prints.append(np.packbits(bits).view(np.uint16))
    prints = np.stack(prints)
    w, i, d = index.near(prints)
    want = {(a, b) for a in range(60) for b in range(60) if distances(prints[a:a + 1], index.prints[b:b + 1])[0] <= RADIUS}
    assert set(zip(w.tolist(), i.tolist())) == want and (d <= RADIUS).all()


def test_fingerprint_of_a_window_is_that_of_its_shingles():
    rng = np.random.default_rng(2)
    s = rng.integers(0, 1 << 63, 30, dtype=np.uint64)
    whole = fingerprints(_bit_votes(s), np.array([4]), 11)
    assert (whole == fingerprints(_bit_votes(s[4:15]), np.array([0]), 11)).all()
    assert similarity(np.unique([1, 1, 2], return_counts=True), np.unique([1, 2, 2], return_counts=True)) == (2, 4)


def test_empty_tables(spark, no_documents):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (None, "a b c")], "doc_id long, text string")
    assert contaminated(docs, none).isEmpty() and drop_contaminated(docs, none).count() == 3
    assert contaminated(no_documents, some).isEmpty()
    assert sorted((r.doc_id, r.item_id) for r in contaminated(docs, some).collect() if r.doc_id) == [(1, 1)]
    assert drop_contaminated(docs, some).isEmpty()


def test_items_of_one_to_four_words_are_found_inside_documents(spark):
    rng = random.Random(9)
    items = [(1, "quark"), (2, "Quark soup"), (3, "red quark soup"), (4, "a red quark soup"), (5, "a red quark soup now")]
    docs = [(k, f"{prose(rng, 30)} {item} {prose(rng, 10)}") for k, item in items]
    docs += [(10, "soup quark"), (11, "quark"), (12, "a red\nquark  soup"), (13, prose(rng, 50)), (14, None)]
    got = {(r.doc_id, r.item_id): r for r in contaminated(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = set()
    for i, text in docs:
        have = (text or "").lower().split()
        for j, item in items:
            w = item.lower().split()
            if any(have[k:k + len(w)] == w for k in range(len(have) - len(w) + 1)):
                want.add((i, j))
    assert set(got) == want and (12, 4) in want
    assert got[3, 3].start_word == 30 and got[3, 3].similarity == 1


def test_ten_thousand_items_take_one_pass(spark):
    rng = random.Random(10)
    items = [(k, prose(rng, 8 + k % 30, "b", 100_000)) for k in range(10_000)]
    docs = [(k, f"{prose(rng, 20)} {items[k * 37][1]} {prose(rng, 20)}" if k % 2 else prose(rng, 60)) for k in range(200)]
    hits = contaminated(spark.createDataFrame(docs, "doc_id long, text string").repartition(4),
                        spark.createDataFrame(items, "item_id long, text string"))
    assert hits._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert {(r.doc_id, r.item_id) for r in hits.collect()} == {(k, k * 37) for k in range(1, 200, 2)}


def test_windows_at_the_threshold_are_found():
    """Edited items at the least similarity from 0.8 on that their size allows: none is lost."""
    rng = np.random.default_rng(3)
    items = [rng.integers(0, 1 << 63, int(n), dtype=np.uint64) for n in rng.integers(9, 60, 400)]
    index = ItemIndex(list(range(400)), items, [5] * 400)
    asked = 0
    for k, item in enumerate(items):
        for _ in range(5):
            n = len(item)
            edits = int(n - np.ceil(n * 8 / 9))  # changed shingles at which the Jaccard similarity is 0.8 or just above
            changed = item.copy()
            changed[rng.choice(n, edits, replace=False)] = rng.integers(0, 1 << 63, edits, dtype=np.uint64)
            both, either = similarity(np.unique(changed, return_counts=True), index.bags[k])
            assert both * 5 >= either * 4
            _, found, _ = index.near(fingerprints(_bit_votes(changed), np.zeros(1, int), n))
            assert k in found
            asked += 1
    assert asked == 2000
