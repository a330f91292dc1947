"""Exact dedup (radix), n-gram Jaccard join, components."""

import hashlib
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from salesmart.llm import ngram_join, shared
from salesmart.llm.exact_dedup import drop_exact_copies, exact_groups
from salesmart.llm.ngram_join import boundary, near_duplicates, needed
from salesmart.llm.shared import components
from tests.llm import brute


def test_exact_groups_match_brute_force(documents):
    frame, rows = documents
    want = brute.keepers([(r[0], r[1]) for r in rows])
    got = {r.doc_id: r for r in exact_groups(frame).collect()}
    assert {i: r.keep_id for i, r in got.items()} == want
    for i, text, *_ in rows:
        r = got[i]
        assert r.group_size == sum(1 for v in want.values() if v == r.keep_id)
        assert r.kept == (r.keep_id == i)
        assert r.text_sha256 == hashlib.sha256(brute.normal(text).encode()).hexdigest()


def test_exact_groups_chunk_borders(spark):
    # Texts that end or differ at, before and after the edges of a round.
    rows, k = [], 0
    for n in (63, 64, 65, 575, 576, 577, 4671, 4672, 4673):
        for text in ("é" * (n // 2) + "a" * (n % 2), "a" * n, "a" * (n - 1) + "b", "a" * (n + 1), "a" * n + " "):
            rows.append((k, text))
            k += 1
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.keep_id for r in exact_groups(frame).collect()} == brute.keepers(rows)


def test_exact_repeated_rows_null_ids_and_empty(spark, documents, no_documents):
    rows = [(5, "a b"), (5, "a b"), (None, "ab"), (5, "x"), (None, "y"), (7, None), (8, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = exact_groups(frame).collect()
    assert len(got) == len(rows)
    assert sorted((r.keep_id, r.group_size) for r in got if r.group_size > 1) == [(5, 3)] * 3 + [(7, 2)] * 2
    assert sum(r.kept for r in got) == 4
    assert sorted(map(tuple, drop_exact_copies(frame).collect()), key=str) == sorted(
        [(5, "a b"), (5, "x"), (None, "y"), (7, None)], key=str)
    assert exact_groups(no_documents).isEmpty() and drop_exact_copies(no_documents).isEmpty()
    kept = drop_exact_copies(documents[0])
    assert kept.columns == documents[0].columns
    assert {r.doc_id for r in kept.collect()} == set(brute.keepers([(r[0], r[1]) for r in documents[1]]).values())


def test_near_duplicates_match_brute_force(documents):
    frame, rows = documents
    got = {r.doc_id: r for r in near_duplicates(frame).collect()}
    assert {i: r.component_id for i, r in got.items()} == brute.components([(r[0], r[1]) for r in rows])
    assert {i: r.n_shingles for i, r in got.items()} == {r[0]: len(set(brute.shingles(r[1]))) for r in rows}


def test_near_duplicates_at_the_threshold(spark):
    # Pairs of sets with every overlap around 0.8, small sizes included.
    rows, k = [], 0
    for n in (4, 5, 6, 8, 9, 10, 13, 14, 15, 20, 45):
        for cut in range(0, 6):
            stem = f"s{n}c{cut}"
            left = [f"{stem}w{i}" for i in range(n + 4)]
            rows += [(k, " ".join(left)), (k + 1, " ".join(left[cut:] + [f"{stem}e{i}" for i in range(cut % 3)]))]
            k += 2
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_duplicates(frame).collect()}
    assert got == brute.components(rows)


def test_near_duplicates_defined_cases(spark, no_documents):
    text = "a b c d e f g h i j k l"
    rows = [(None, text), (3, text), (3, text), (9, text + " m"), (4, None), (6, "")]
    got = sorted(map(tuple, near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert got == sorted([(None, 8, 3), (3, 8, 3), (3, 8, 3), (9, 9, 3), (4, 0, 4), (6, 0, 6)], key=str)
    assert near_duplicates(no_documents).isEmpty()


def test_boundary_weighs_subsets_against_lists():
    sizes = {n: 100 for n in range(4, 300)}
    assert 3 <= boundary(sizes, 1.5) <= boundary(sizes, 4.0) < boundary(sizes, 40.0)
    assert [needed(n) for n in (4, 5, 9, 10)] == [4, 4, 8, 8]


@pytest.mark.parametrize("per_task", [1 << 20, 30])
def test_components_of_chains_stars_and_rings(spark, monkeypatch, per_task):
    monkeypatch.setattr(shared, "LINKS_PER_TASK", per_task)
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, 500 + k) for k in range(1, 50)]
    edges += [(900 + k, 900 + (k + 1) % 20) for k in range(20)] + [(7, 3), (3, 7), (-4, 2)]
    names = {x for e in edges for x in e}
    shift = dict(zip(sorted(names), rng.sample(sorted(names), len(names))))
    edges = [(shift[a], shift[b]) for a, b in edges]
    parent = {x: x for x in names}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    got = components(spark.createDataFrame(edges, "a long, b long"))
    assert {r.node: r.component for r in got.collect()} == {x: root(x) for x in names}
    assert components(spark.createDataFrame([], "a long, b long")).isEmpty()


def test_stage_drops_the_very_rows_that_are_not_kept(spark):
    """One id with texts that differ in white space only, rows repeated whole,
    null ids: of equal texts one row stays, whatever else is equal."""
    from salesmart.llm.exact_dedup import drop_exact_copies
    rows = [(1, "a b", 1), (1, "a  b", 2), (1, "ab", 3), (2, "c", 4), (2, "c", 4), (2, "c", 4), (None, None, 5), (None, "", 6),
            (None, " ", 7), (3, "x" * 700, 8), (4, "x" * 700, 9), (4, "x" * 699 + "y", 10), (5, "ab", 11)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, n long").repartition(4)
    kept = sorted((tuple(r) for r in drop_exact_copies(frame).collect()), key=str)
    assert kept == sorted([(1, "a  b", 2), (2, "c", 4), (None, " ", 7), (3, "x" * 700, 8), (4, "x" * 699 + "y", 10)], key=str)


def test_counting_shingles_takes_little_beside_their_window():
    """A window of distinct shingles is sorted where it stands; what a task
    holds beside it does not grow with the window."""
    window = ngram_join.COUNT_FLUSH
    texts = [" ".join(f"w{i}" for i in range(k, k + 100_000)) for k in range(0, window + 200_000, 100_000)]
    texts.append(texts[-1] + " more")  # shares its shingles with the set before
    texts += texts[3:5]  # equal sets are counted once
    batches = [pa.RecordBatch.from_arrays([pa.array([i]), pa.array([t])], ["doc_id", "text"]) for i, t in enumerate(texts)]
    tracemalloc.start()
    found = list(ngram_join._document_sets(iter(batches)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 3 * 8 * window, peak
    rows = pa.Table.from_batches(found)
    assert rows.filter(pc.equal(rows["kind"], 0))["n"].to_pylist() == [99_996] * (len(texts) - 3) + [99_997] + [99_996] * 2
    again = rows.filter(pc.equal(rows["kind"], 1))["seen"].to_pylist()
    assert set(again) == {2} and len(again) == 99_996


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 9), max_size=40))
def test_shingles_seen_often(values):
    want, counts = np.unique(np.array(values, np.uint64), return_counts=True)
    shingle, seen = ngram_join._seen_often(np.array(values, np.uint64))
    assert (shingle.tolist(), seen.tolist()) == (want[counts > 1].tolist(), counts[counts > 1].tolist())


def test_texts_reach_tasks_in_small_batches(spark):
    frame = spark.range(400).select("id", F.repeat(F.lit("x"), 10_000).alias("text")).coalesce(1)
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["bytes"])

    with shared.arrow_batches(spark, "256k"):
        got = [r.bytes for r in frame.mapInArrow(sizes, "bytes long").collect()]
    assert max(got) < 300_000 and sum(got) > 4_000_000
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == before
