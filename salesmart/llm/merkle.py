"""Merkle manifest of a dataset by sibling-shift self-joins.

Every row is a leaf: the digest of its fields, each written as ``-`` when null
and as byte count, ``:`` and value otherwise. The rows of a group, in ascending
order of their id, are the leaves of one tree; the roots of all groups, in
order of the group name (null first, then bytes), are the leaves of the tree of
the whole dataset. A digest is the lower-case hex SHA-256 of its concatenated
inputs, digests taken as hex text.

One level of all trees is one self-join. A node knows its slot in its run of
``ARITY`` nodes, so it can compute the indices of its siblings (index XOR 1 for
binary trees, every other slot offset otherwise) and equijoins the level on
them. What it finds is its part of the proof, and the rows of slot zero, which
then hold their whole run, emit the parents. A level of a billion nodes and the
hot group that holds a third of them are joined on (group, run), at most
``ARITY`` rows a key. Going down again, each run joins its parent's proof.

Positions come from a range partitioning: a row's index is its place in its
partition and the rows of its group in the partitions before, counted from one
row per (partition, group).

Defined cases: nulls in any field are leaves of their own text (``-``), a null
group is a group of its own and comes first; a null id sorts before all others;
equal ids are ordered by their leaf, and rows repeated whole stand side by side
and have equal digests; a group of one row has its leaf as root and no siblings
there, so the proof of a dataset of one row is the digest of nothing; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesmart.llm.shared import stored

ARITY = 16
HEX = 64  # characters of a digest
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPER_MOD = 5
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def field(col: Column) -> Column:
    """A field as the leaf digest takes it."""
    text = col.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def group_key(col: Column) -> Column:
    """A group's name as a key that is never null and sorts null first."""
    return F.coalesce(F.concat(F.lit("="), col.cast("string")), F.lit(""))


def with_positions(rows: DataFrame, tree: str, order: Sequence[str], label: str) -> DataFrame:
    """``rows`` with ``idx``, their place in their tree by ``order``, and
    ``size``, the rows of that tree. Nothing is gathered: a tree spread over
    many partitions costs one row in each of them."""
    keys = [tree, *order]
    placed = stored(rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
                    .withColumn("part", F.spark_partition_id())
                    .withColumn("at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))), f"{label}-placed")
    counts = placed.groupBy(tree, "part").agg(F.count("*").alias("here"), F.min("at").alias("first"))
    parts = Window.partitionBy(tree)
    before = F.sum("here").over(parts.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(tree, "part", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"),
                            F.sum("here").over(parts).alias("size"))
    return placed.join(offsets, [tree, "part"]).withColumn("idx", F.col("at") + F.col("shift")).drop("part", "at", "shift")


@contextmanager
def co_partitioned(spark: SparkSession) -> Iterator[None]:
    """Plans made inside may join on more keys than their inputs are dealt by,
    so rows dealt by (tree, run) are not shuffled again by slot. A run has
    ``ARITY`` rows at most, so nothing is lost in evenness."""
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def sibling_slots(slot: Column, run: Column, size: Column, arity: int) -> Column:
    """Slots of the run in which siblings stand."""
    if arity == 2:
        wanted = F.array(slot.bitwiseXOR(F.lit(1)))
    else:
        wanted = F.transform(F.sequence(F.lit(1), F.lit(arity - 1)), lambda shift: (slot + shift) % arity)
    return F.filter(wanted, lambda other: run * arity + other < size)


def with_siblings(nodes: DataFrame, arity: int = ARITY) -> DataFrame:
    """``nodes`` (tree, idx, size, node and more) with ``run``, ``slot`` and
    ``siblings``, the digests of the run's other nodes from left to right.
    Planned inside ``co_partitioned``, it shuffles the nodes once."""
    dealt = (nodes.withColumn("run", F.expr(f"idx div {arity}")).withColumn("slot", (F.col("idx") % arity).cast("int"))
             .repartition("tree", "run"))  # one exchange serves all three uses: siblings meet in a task
    asks = dealt.select("tree", "run", "slot",
                        F.explode(sibling_slots(F.col("slot"), F.col("run"), F.col("size"), arity)).alias("other"))
    have = dealt.select("tree", "run", F.col("slot").alias("other"), "node")
    found = asks.join(have.hint("merge"), ["tree", "run", "other"]).groupBy("tree", "run", "slot").agg(
        F.array_sort(F.collect_list(F.struct("other", "node"))).alias("found"))  # arity - 1 digests at most
    return (dealt.join(found.hint("merge"), ["tree", "run", "slot"], "left")
            .withColumn("siblings", F.coalesce(F.array_join(F.col("found.node"), ""), F.lit(""))).drop("found"))


def parent(node: Column, slot: Column, siblings: Column) -> Column:
    """The digest of a run, from one of its nodes and the others."""
    at = slot * HEX
    return digest(F.substring(siblings, F.lit(1), at), node, F.substring(siblings, at + 1, F.length(siblings)))


def _levels(leaves: DataFrame, arity: int, label: str) -> tuple[list[DataFrame], DataFrame]:
    """The levels of all trees of ``leaves`` (tree, idx, size, node; more on
    the first level), each node with its step of the proof, and the roots with
    the height of their tree."""
    levels, nodes, roots = [], leaves, None
    most = leaves.agg(F.max("size").alias("most")).first()["most"] or 0
    while True:
        done = nodes.where("size = 1").select("tree", "node", F.lit(len(levels)).alias("height"))
        roots = roots.unionByName(done) if roots is not None else done
        if most <= 1:
            return levels, roots
        up = F.when(F.col("slot") == 0, parent(F.col("node"), F.col("slot"), F.col("siblings")))
        step = F.struct("slot", F.unhex("siblings").alias("siblings"))  # bytes: half the size
        with co_partitioned(leaves.sparkSession):
            level = stored(with_siblings(nodes.where("size > 1"), arity).withColumns({"up": up, "step": step})
                           .drop("siblings"), f"{label}-{len(levels)}")
        levels.append(level)
        nodes = level.where("slot = 0").select("tree", F.col("run").alias("idx"), F.col("up").alias("node"),
                                               F.expr(f"(size + {arity - 1}) div {arity}").alias("size"))
        most = -(-most // arity)


def _proofs(leaves: DataFrame, levels: list[DataFrame], tops: DataFrame, carried: Sequence[str]) -> DataFrame:
    """``carried`` columns of every leaf with ``proof``, its steps from its own
    level up, and the other columns of its tree's row of ``tops`` (tree,
    height, proof: the steps that follow its root's)."""
    columns = [c for c in tops.columns if c not in ("tree", "height", "proof")]
    alone = leaves.where("size = 1").join(tops.where("height = 0").drop("height"), "tree")
    if not levels:
        return alone.select(*carried, "proof", *columns)

    def of_height(k: int) -> DataFrame:
        return tops.where(F.col("height") == k).select("tree", F.lit(0).cast("long").alias("run"), "proof", *columns)

    above = of_height(len(levels))
    for k in range(len(levels) - 1, -1, -1):
        below = levels[k].join(above, ["tree", "run"]).withColumn("proof", F.concat(F.array("step"), F.col("proof")))
        if k:
            above = below.select("tree", F.col("idx").alias("run"), "proof", *columns).unionByName(of_height(k))
    return below.select(*carried, "proof", *columns).unionByName(alone.select(*carried, "proof", *columns))


def manifest(docs: DataFrame, id_col: str = "doc_id", group_col: str = "source", fields: Sequence[str] = FIELDS,
             arity: int = ARITY, tampered: tuple[Column, dict[str, Column]] | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, leaf, other_leaf (for a check: where
    the condition of ``tampered`` holds, the leaf with its fields in place of
    the row's; else null), subroot, root and proof, an array of (slot, siblings
    as bytes) from the leaf to the root of the dataset."""
    where, replaced = tampered or (F.lit(False), {})
    other = F.when(where, digest(*[field(replaced.get(c, F.col(c))) for c in fields]))
    rows = stored(docs.select(group_key(F.col(group_col)).alias("tree"), F.col(id_col).alias("doc_id"),
                              digest(*[field(F.col(c)) for c in fields]).alias("node"), other.alias("other_leaf"),
                              F.monotonically_increasing_id().alias("row")), "merkle-leaves")
    leaves = with_positions(rows, "tree", ["doc_id", "node", "row"], "merkle")
    leaves = stored(leaves.drop("row"), "merkle-nodes")
    levels, roots = _levels(leaves, arity, "merkle-level")

    # The tree of the dataset: its leaves are the roots of the groups.
    groups = with_positions(roots.select(F.lit("").alias("tree"), F.col("tree").alias("group"), "node", "height"),
                            "tree", ["group"], "merkle-top")
    top_leaves = stored(groups, "merkle-top-nodes").withColumnRenamed("height", "group_height")
    top_levels, top = _levels(top_leaves, arity, "merkle-top-level")
    nothing = F.array().cast("array<struct<slot:int,siblings:binary>>")
    above = _proofs(top_leaves, top_levels, top.withColumnRenamed("node", "root").withColumn("proof", nothing),
                    ["group", "node", "group_height"])
    tops = above.select(F.col("group").alias("tree"), F.col("group_height").alias("height"), "proof",
                        F.col("node").alias("subroot"), "root")
    return _proofs(leaves, levels, tops, ["doc_id", F.col("node").alias("leaf"), "other_leaf"])


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and a proof lead to."""
    return F.aggregate(proof, leaf, lambda node, step: parent(node, step["slot"], F.lower(F.hex(step["siblings"]))))


def proof_digest(proof: Column) -> Column:
    """Digest of all siblings of a proof, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda step: F.lower(F.hex(step["siblings"]))), ""), 256)


def verify_manifest(docs: DataFrame) -> DataFrame:
    """The manifest of ``docs`` with every row checked against it; rows whose
    id's CRC-32 ``TAMPER_MOD`` divides are checked with their text lower-cased."""
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPER_MOD == 0
    rows = manifest(docs, tampered=(chosen, {"text": F.translate("text", UPPER, UPPER.lower())}))
    root = folded(F.coalesce("other_leaf", "leaf"), F.col("proof"))
    return (rows.withColumn("folded_root", root)
            .select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"),
                    "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")))
