from collections import defaultdict

import pytest

from salesmart.llm.mixing import mix_documents, mixed
from tests.llm import brute


def test_mix_matches_its_contract(documents):
    frame, rows = documents
    got = {r.doc_id: r for r in mixed(frame).collect()}
    sizes = defaultdict(int)
    for i, text, _, source, _ in rows:
        assert got[i].size == len(brute.words(text))
        sizes[source] += got[i].size
    want, taken = brute.targets(dict(sizes)), defaultdict(int)
    assert abs(sum(want.values()) - 1.5 * sum(sizes.values())) < 1e-6
    for i, _, _, source, _ in rows:
        r = got[i]
        assert r.source_size == sizes[source] and abs(r.target - want[source]) < 1e-6
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 2
        taken[source] += r.taken
    for source, target in want.items():
        # No nearer than whole documents allow: one source's is mostly one text.
        largest = max(got[r[0]].size for r in rows if r[3] == source)
        assert abs(taken[source] - target) <= max(10, 0.02 * target, largest / 2 if largest > target / 2 else 0), source
    again = {r.doc_id: r.taken for r in mixed(frame.repartition(3)).collect()}
    assert again == {i: r.taken for i, r in got.items()}


def test_rates_tilt_with_size_within_a_source(spark):
    rows = [(i, " ".join(["w"] * (1 + i % 50)), "a" if i % 2 else "b") for i in range(600)]
    rows += [(1000 + i, "x " * 400, "c") for i in range(20)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixed(frame).collect()
    by = defaultdict(list)
    for r in got:
        by[rows[r.doc_id][2] if r.doc_id < 1000 else "c"].append(r)
    for members in by.values():
        total, target = sum(r.taken for r in members), members[0].target
        assert abs(total - target) <= 0.01 * target + 5
    rates = [sum(r.copies for r in by["a"] if lo < r.size <= lo + 25) for lo in (0, 25)]
    full = members and by["a"][0].target == 2 * by["a"][0].source_size
    assert full or rates[0] != rates[1]


def test_hot_cells_copies_and_clashing_names(spark, documents, no_documents):
    rows = [(i, "same words here", "s") for i in range(200)] + [(None, "a b", None), (None, None, "z"), (7, "", "s")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)
    got = mixed(frame).collect()
    assert len(got) == len(rows)
    s = [r for r in got if r.size == 3]
    assert abs(sum(r.taken for r in s) - s[0].target) <= 3
    assert mixed(no_documents).isEmpty() and mix_documents(no_documents).isEmpty()
    mix = mix_documents(documents[0])
    assert mix.columns == [*documents[0].columns, "_copy"]
    copies = {r.doc_id: r.copies for r in mixed(documents[0]).collect()}
    found = defaultdict(list)
    for r in mix.select("doc_id", "_copy").collect():
        found[r.doc_id].append(r._copy)
    assert {i: sorted(v) for i, v in found.items()} == {i: list(range(1, c + 1)) for i, c in copies.items() if c}


def test_sources_that_newton_leaves_are_halved_or_raise(spark, documents, monkeypatch):
    import salesmart.llm.mixing as module
    expected = {r.doc_id: r.taken for r in mixed(documents[0]).collect()}
    monkeypatch.setattr(module, "MAX_ITERATIONS", 0)
    assert {r.doc_id: r.taken for r in mixed(documents[0]).collect()} == expected
    monkeypatch.setattr(module, "HALVINGS", 2)
    with pytest.raises(RuntimeError, match="no tilt"):
        mixed(documents[0]).collect()
