"""Exact deduplication by distributed MSD radix partitioning.

Documents are split by their successive bytes: the first 64 bytes of the
normalised text, then the next 512, and so on by a factor of 8, until a group
holds one document or its text has ended. Two texts are equal exactly when
they walk through the same groups to their end, so equality is decided by the
bytes themselves; no digest takes part in it.

Each round counts the groups with a map-side combined aggregate, drops the
documents that are alone, and joins the rest to their group through a salted
key, so a group with a third of all rows is dealt over many tasks and is never
gathered. The first round counts on the first bytes alone, and a round carries
only the bytes not yet read of documents that still share all others.

Defined cases: a null text counts as empty; empty texts are equal to each
other; ties on length go to the smallest id, a null id last; rows repeated
with id and text alike belong to one group and one of them is kept; an empty
table gives an empty result; other columns of the input, whatever their names,
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.shared import salted_join, stored

FIRST_WIDTH = 64
GROWTH = 8
WHITE = " \t\n\x0b\x0c\r"


def normalised(text: Column) -> Column:
    """The text without any character of ``[\\x20\\x09-\\x0D]``; null is empty."""
    return F.translate(F.coalesce(text, F.lit("")), WHITE, "")


def _with_group(rows: DataFrame, groups: DataFrame, how: str = "inner") -> DataFrame:
    """``rows`` joined to their group by gid and chunk."""
    return salted_join(rows, groups, ["gid", "chunk"], ["doc_id", "cp"], how)


def _shared_groups(rows: DataFrame, width: int) -> DataFrame:
    """Groups of two rows or more after ``width`` further bytes; the new group
    is named by a member, which no other group has."""
    return stored(rows.groupBy("gid", "chunk")
                  .agg(F.count("*").alias("n"),
                       F.min(F.concat_ws(":", F.col("doc_id").cast("string"), "sha")).alias("next_gid"))
                  .where("n > 1").drop("n"), f"radix-groups-{width}")


def _regrouped(joined: DataFrame, member: list[str], width: int) -> DataFrame:
    return joined.select(F.col("next_gid").alias("gid"), *member, (F.length("chunk") < width).alias("ended"), "rest")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """One row per document: doc_id, keep_id (most code points, then smallest
    id, of the equal texts), group_size, kept, text_sha256 (of the normalised
    text, for the record only) and, with ``row_col`` (a key that every row has
    for itself), that key as ``row``."""
    norm, width = normalised(F.col(text_col)), FIRST_WIDTH
    carried = ["row"] if row_col else []
    member = ["doc_id", "cp", "sha", *carried]
    own = [F.lit("").alias("gid"), F.col(id_col).alias("doc_id"), F.length(F.coalesce(F.col(text_col), F.lit(""))).alias("cp")]
    own += [F.col(row_col).alias("row")] if row_col else []
    heads = stored(docs.select(*own, F.sha2(norm, 256).alias("sha"),
                               F.substring(norm.cast("binary"), 1, width).alias("chunk")), "radix-heads")
    groups = _shared_groups(heads, width)
    alone = [_with_group(heads, groups, "left_anti").select(*member)]
    whole = docs.select(*own, norm.cast("binary").alias("bytes")).withColumn("chunk", F.substring("bytes", 1, width))
    joined = _with_group(whole, groups).withColumn("sha", F.sha2("bytes", 256)).withColumn(
        "rest", F.expr(f"substring(bytes, {width + 1})"))
    ended = []
    while True:
        shared = stored(_regrouped(joined, member, width), f"radix-{width}")
        ended.append(shared.where("ended").select("gid", *member))
        rows = shared.where("not ended")
        if rows.isEmpty():
            break
        width *= GROWTH
        cut = rows.select("gid", *member, F.substring("rest", 1, width).alias("chunk"),
                          F.expr(f"substring(rest, {width + 1})").alias("rest"))
        groups = _shared_groups(cut, width)
        alone.append(stored(_with_group(cut.drop("rest"), groups, "left_anti").select(*member), f"radix-alone-{width}"))
        joined = _with_group(cut, groups)

    def union(parts: list[DataFrame]) -> DataFrame:
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    members = union(ended)
    best = F.min(F.struct((-F.col("cp")).alias("len"), F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id")))
    groups = members.groupBy("gid").agg(F.count("*").alias("group_size"), best.alias("best"))
    grouped = salted_join(members, groups, ["gid"], ["doc_id", "cp"]).select(
        "gid", *member, "group_size", F.col("best.id").alias("keep_id"),
        (F.col("doc_id").eqNullSafe(F.col("best.id")) & (F.col("cp") == -F.col("best.len"))).alias("first"))
    # Rows repeated with the same id: one of them stays.
    same = Window.partitionBy("gid", "doc_id").orderBy("cp", *carried)
    firsts = grouped.where("first").withColumn("kept", F.row_number().over(same) == 1)
    others = grouped.where("not first").withColumn("kept", F.lit(False))
    columns = ["doc_id", "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256"), *carried]
    lone = union(alone).select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
                               F.lit(True).alias("kept"), "sha", *carried)
    return firsts.select(*columns).unionByName(others.select(*columns)).unionByName(lone.select(*columns))


_ROW = "__row"


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that ``exact_groups`` does not keep. Every row
    is numbered and written once, so what is dropped is that very row, whatever
    ids and texts are repeated; no digest takes part."""
    rows = stored(docs.withColumn(_ROW, F.monotonically_increasing_id()), "exact-rows")
    dropped = exact_groups(rows, id_col, text_col, _ROW).where("not kept").select(F.col("row").alias(_ROW))
    return rows.join(dropped, _ROW, "left_anti").select(*docs.columns)
