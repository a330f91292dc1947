"""The corpus pipeline: raw documents to a training mix, stage by stage.

Every stage reads what its predecessor wrote (Parquet in the shared folder)
and works on all of it; each decision takes effect on the rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from salesmart.llm.decontaminate import drop_contaminated
from salesmart.llm.exact_dedup import drop_exact_copies
from salesmart.llm.mixing import mix_documents
from salesmart.llm.ngram_join import near_duplicates
from salesmart.llm.shared import read_table, stored
from salesmart.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the toxicity classifier rejects go."""
    return drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal without white space, the longest original stays."""
    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked at 5-gram Jaccard 0.8 or more, the smallest id
    stays (its rows, should the id be repeated)."""
    dropped = near_duplicates(docs).where("doc_id <> component_id").select("doc_id")
    return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it, numbered in ``copy``."""
    return mix_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("ngram_jaccard", near_dedup),
    ("decontaminate", decontaminate),
    ("mix_sources", mix),
]

# Not expressible in SQL (trained classifier, Newton iterations); tested
# stage by stage against brute-force versions in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
