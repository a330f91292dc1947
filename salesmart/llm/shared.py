"""Small helpers of the operators: written tables that cut lineage, a split
for hot keys, and connected components of a link table.

Everything written goes to a fresh folder under the shared checkpoint folder
(``spark.checkpoint.dir``), so every executor and a restarted task sees it.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.session import new_run_dir

LINKS_PER_TASK = 1 << 20
SALTS = 16  # pieces into which the rows of one join key are dealt


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back."""
    path = new_run_dir(df.sparkSession, f"llm/{label}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_batches(spark: SparkSession, size: str) -> Iterator[None]:
    """Jobs run inside hand Python tasks at most ``size`` bytes of rows at a
    time (one row at least) instead of 64 MB. A batch is held several times over
    (Spark's vectors, their stream, the worker's copy) by every running task."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, size)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def salt(*by: Column, salts: int = SALTS) -> Column:
    """The piece of its key that a row belongs to; depends on the row alone."""
    return F.pmod(F.xxhash64(*by), F.lit(salts)).cast("int")


def salted_join(rows: DataFrame, groups: DataFrame, on: list[str], spread: list[str],
                how: str = "inner", salts: int = SALTS) -> DataFrame:
    """``rows`` (any skew) joined to ``groups`` (unique in ``on``): each group
    row is repeated ``salts`` times, so a key that holds a third of the rows
    is dealt over ``salts`` tasks. ``spread`` names columns that tell the rows
    of one key apart. Keys must not be null."""
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(how)
    left = rows.withColumn("_salt", salt(*[F.col(c) for c in spread], salts=salts))
    right = groups.withColumn("_salt", F.explode(F.array(*[F.lit(i) for i in range(salts)])))
    # Merged, not broadcast: size estimates do not see the repetition.
    return left.join(right.hint("merge"), [*on, "_salt"], how).drop("_salt")


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of one task as stars: every node to the smallest it reaches
    over them."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while parent[top] != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for batch in batches:
        for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            parent.setdefault(x, x)
            parent.setdefault(y, y)
            x, y = root(x), root(y)
            if x != y:
                parent[max(x, y)] = min(x, y)
    nodes = [x for x in parent if parent[x] != x]
    for i in range(0, len(nodes), 1 << 16):
        part = nodes[i:i + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array([root(x) for x in part], pa.int64())], ["a", "b"])


def components(links: DataFrame, label: str = "components", max_rounds: int = 60) -> DataFrame:
    """Connected components of undirected ``links`` (a long, b long, a != b).

    Returns (node, component): the smallest node reachable. The links are first
    contracted task by task, ``LINKS_PER_TASK`` at most in each; while more
    than one task is needed, large-star and small-star rounds re-attach each
    node's neighbours to the smallest one known, which ends after a number of
    rounds that grows with the logarithm of a component's size. Only grouped
    minima and joins on node keys; every round is written, none is collected.
    """
    def both(edges: DataFrame) -> DataFrame:
        return edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def state(edges: DataFrame) -> tuple:
        row = edges.agg(F.count("*").alias("n"), F.sum((F.xxhash64("a", "b") % 1_000_003)).alias("h")).first()
        return row["n"], row["h"]

    edges = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b"), label)
    tasks = max(1, -(-edges.count() // LINKS_PER_TASK))
    edges = stored(edges.coalesce(tasks).mapInArrow(_contracted, "a long, b long"), label)
    seen = None
    for _ in range(max_rounds if tasks > 1 else 0):
        every = both(edges)
        least = every.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (every.where("b > a").join(least, "a").where("b <> m")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        small = (joined.select("a", F.col("m").alias("b"))
                 .unionAll(joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))).distinct())
        edges = stored(small, label)
        now = state(edges)
        if now == seen:
            break
        seen = now
    else:
        if tasks > 1:
            raise RuntimeError("components did not settle")
    # Settled: every edge leads from a node straight to its component's least.
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionAll(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
