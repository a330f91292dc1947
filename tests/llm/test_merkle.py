"""The Merkle manifest against a version in plain Python."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from salesmart.llm import merkle

UPPER = str.maketrans(merkle.UPPER, merkle.UPPER.lower())


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (*row[:1], row[3], row[2], row[4], text)))


def levels(nodes, arity):
    out = [nodes]
    while len(nodes) > 1:
        nodes = [sha("".join(nodes[i:i + arity])) for i in range(0, len(nodes), arity)]
        out.append(nodes)
    return out


def climb(tree, index, start, arity):
    """(siblings, root) of a leaf that is ``start`` instead."""
    seen = []
    for nodes in tree[:-1]:
        first = index - index % arity
        run = nodes[first:first + arity]
        seen += run[:index - first] + run[index - first + 1:]
        run[index - first] = start
        start, index = sha("".join(run)), index // arity
    return seen, start


def brute(rows, arity=16):
    """Rows (doc_id, text, lang, source, n_chars) to the manifest's rows."""
    groups = {}
    for r in rows:
        groups.setdefault(r[3], []).append((r[0] is not None, r[0] or 0, leaf(r, r[1]), r))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        groups[s].sort(key=lambda x: x[:3])
        trees[s] = levels([x[2] for x in groups[s]], arity)
    top = levels([trees[s][-1][0] for s in names], arity) if names else []
    out = []
    for k, s in enumerate(names):
        for i, (_, _, own, r) in enumerate(groups[s]):
            start = own
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                start = leaf(r, None if r[1] is None else r[1].translate(UPPER))
            below, node = climb(trees[s], i, start, arity)
            above, root = climb(top, k, node, arity)
            out.append((r[0], own, trees[s][-1][0], top[-1][0], sha("".join(below + above)), root, root == top[-1][0]))
    return out


def ordered(rows):
    return sorted(map(tuple, rows), key=str)


def test_manifest_matches_brute_force(spark, documents, no_documents):
    frame, rows = documents
    got = merkle.verify_manifest(frame).collect()
    assert ordered(got) == ordered(brute([r[:5] for r in rows]))
    assert {r.verified for r in got} == {True, False}
    assert merkle.verify_manifest(no_documents).isEmpty()


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("sizes", [(1,), (1, 1), (16, 17, 1), (33, 2, 256, 257), tuple([1] * 18)])
def test_runs_of_every_length(spark, sizes):
    rows = [(100 * k + i, f"Text {i}", "en", f"s{k:02d}", 6) for k, n in enumerate(sizes) for i in range(n)]
    assert ordered(merkle.verify_manifest(spark.createDataFrame(rows, SCHEMA)).collect()) == ordered(brute(rows))


def test_repeated_rows_null_ids_and_names(spark):
    rows = [(5, "A", "en", None, 1)] * 40 + [(5, "B", "en", None, 1), (None, "C", None, "", None), (None, None, None, "", None),
                                              (None, "C", None, "", None), (7, "Ä", "de", "é", 1), (8, "z", "de", "z", 1),
                                              (9, "z", "de", "\U0001F600", 1)]
    got = merkle.verify_manifest(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    want = ordered(brute(rows))
    # Equal rows may change places, their proofs with them; all else is as given.
    assert [r[:4] for r in ordered(got)] == [r[:4] for r in want]
    assert sorted(r[4:] for r in map(tuple, got)) == sorted(r[4:] for r in want)


def test_binary_trees_pair_by_exclusive_or(spark):
    rows = [(i, f"t{i}", "en", "s" if i < 21 else "u", i) for i in range(26)]
    got = merkle.manifest(spark.createDataFrame(rows, SCHEMA), arity=2).select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")).alias("p"),
        merkle.folded(F.col("leaf"), F.col("proof")).alias("f")).collect()
    want = {r[0]: r for r in brute(rows, 2)}
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r)[:5] == want[r.doc_id][:5] and r.f == r.root


def test_siblings_meet_without_a_second_shuffle(spark):
    nodes = spark.range(1000).select(F.concat(F.lit("t"), (F.col("id") % 1).cast("string")).alias("tree"), F.col("id").alias("idx"), F.lit(1000).cast("long").alias("size"),
                                     F.sha2(F.col("id").cast("string"), 256).alias("node"))
    with merkle.co_partitioned(spark):
        plan = merkle.with_siblings(nodes)._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert dealt and all("REPARTITION_BY_COL" in line for line in dealt)  # none asked for by a join or an aggregate
    assert plan.count("SortMergeJoin") == 2 and "slot" not in "".join(dealt)
