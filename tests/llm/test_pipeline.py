"""The corpus pipeline and the registered queries."""

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline
from salesmart.llm.queries import ORACLE, QUERIES
from salesmart.llm.shared import stored
from tests.conftest import SF001, SF01
from tests.llm import brute


def test_every_operator_has_one_query():
    names = [q for q in E.queries() if q.startswith("op")]
    assert sorted(int(q[2:].split("_")[0]) for q in names) == list(range(1, 14))
    assert "pipeline" in E.queries() and set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_oracle(spark, key):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF01}/{t}.parquet'")
    theirs = con.sql(ORACLE[key]).df()
    ours = QUERIES[key](spark, SF01).toPandas()[list(theirs)]
    plain = [sorted(map(str, f.astype(object).where(f.notna(), None).itertuples(index=False, name=None))) for f in (ours, theirs)]
    number = lambda s: s.replace(".0)", ")").replace(".0,", ",")  # noqa: E731  pandas holds nullable ids as floats
    assert [number(s) for s in plain[0]] == [number(s) for s in plain[1]]


def test_stages_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in docs.collect()]
        after = stored(stage(spark, docs, SF001), f"test-{name}")
        ids = [r.doc_id for r in after.collect()]
        if name != corpus_pipeline.STAGES[-1][0]:
            assert after.columns == columns and len(ids) == len(set(ids))
        if name == "toxicity":
            scores = QUERIES["op7_toxicity"](spark, SF001).collect()
            assert set(ids) == {r.doc_id for r in scores if not r.predicted}
        elif name == "exact_dedup":
            assert set(ids) == set(brute.keepers(before).values())
        elif name == "ngram_jaccard":
            assert set(ids) == set(brute.components(before).values())
        elif name == "decontaminate":
            dirty = {i for i, _ in brute.contained(before, bench)}
            assert set(ids) == {i for i, _ in before} - dirty
        elif name == "mix_sources":
            sources, taken = {r.doc_id: r.source for r in docs.collect()}, {}
            sizes = {}
            for i, text in before:
                sizes[sources[i]] = sizes.get(sources[i], 0) + len(brute.words(text))
            words = {i: len(brute.words(t)) for i, t in before}
            for i in ids:
                taken[sources[i]] = taken.get(sources[i], 0) + words[i]
            assert max(ids.count(i) for i in set(ids)) <= 2
            for s, target in brute.targets(sizes).items():
                assert abs(taken.get(s, 0) - target) <= 0.05 * target + 20
        docs = after


def test_stages_take_clashing_columns_and_empty_tables(spark, documents, no_documents):
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, documents[0], SF001)
        assert set(documents[0].columns) <= set(out.columns), name
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == documents[0].columns
        assert not out.isEmpty() and stage(spark, no_documents, SF001).isEmpty(), name
