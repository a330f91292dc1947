"""Deduplication with a defined survivor (E1, E3).

The survivor is the first row under an explicit total order: the position in
the files where the rows carry one (``readers.POSITION``: keep the first in file
order), else the remaining columns in schema order, ascending, nulls first. The
``row_number() ... = 1`` shape lets Spark insert a partial
``WindowGroupLimit`` before the shuffle, so a key repeated in many input
partitions ships at most one row per partition.

:func:`clustered_first` deduplicates rows that are dealt by a coarser key than
their own, for tables that are stored in that partitioning; there the keys with
very many copies are reduced first (:func:`hot_keys`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.sources.readers import POSITION

HOT_COPIES = 1_000     # copies from which a key is reduced before the shuffle
HOT_KEYS = 100_000     # most such keys: a key also needs one in so many of all rows

_RN = "__salesmart_rn"


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per ``keys``: the first under ``order``."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RN, F.row_number().over(w)).where(F.col(_RN) == 1).drop(_RN)


def survivor_order(df: DataFrame, pk: Sequence[str]) -> list[Column]:
    """What decides between rows of one key."""
    cols = [POSITION] if POSITION in df.columns else [c for c in df.columns if c not in pk]
    return [F.col(c).asc_nulls_first() for c in (cols or pk)]


def dedup(df: DataFrame, pk: Sequence[str], order_by: Sequence[str] | None = None) -> DataFrame:
    """Drop rows repeating the primary key ``pk``, keeping the first under
    ``order_by`` (default: :func:`survivor_order`)."""
    order = [F.col(c).asc_nulls_first() for c in order_by] if order_by else survivor_order(df, pk)
    return first_per_key(df, pk, order).drop(POSITION)


def hot_keys(df: DataFrame, pk: Sequence[str], rows: int) -> DataFrame:
    """Keys of ``df`` (``rows`` rows) with very many copies, as ``__hot0`` and so
    on; ``HOT_KEYS`` at most, by the threshold. Counted with map-side partials,
    keys only."""
    least = max(HOT_COPIES, -(-rows // HOT_KEYS))
    return (df.groupBy(*[F.col(c).alias(f"__hot{i}") for i, c in enumerate(pk)]).agg(F.count(F.lit(1)).alias("__copies"))
            .where(F.col("__copies") >= least).drop("__copies"))


def clustered_first(df: DataFrame, pk: Sequence[str], cluster: Sequence[str], rows: int, partitions: int) -> DataFrame:
    """``dedup`` of ``df`` (``rows`` rows) on ``pk``, its rows dealt into
    ``partitions`` by ``cluster`` (columns that ``pk`` determines) and sorted
    there by cluster and key. One shuffle of the rows, beside one of key counts:
    keys with very many copies are cut to one row per map task before it."""
    order = survivor_order(df, pk)
    same = [F.col(c).eqNullSafe(F.col(f"__hot{i}")) for i, c in enumerate(pk)]
    few = F.broadcast(hot_keys(df, pk, rows))  # HOT_KEYS rows at most
    cold = df.join(few, same, "left_anti")
    firsts = first_per_key(df.join(few, same, "left_semi"), pk, order)
    rest = [c for c in pk if c not in cluster]
    w = Window.partitionBy(*cluster).orderBy(*[F.col(c).asc_nulls_first() for c in rest], *order)
    before = F.lag(F.struct(*rest)).over(w)  # a struct is null only where there is no row before
    dealt = cold.unionByName(firsts).repartition(partitions, *cluster)
    return (dealt.withColumn(_RN, before.isNull() | ~before.eqNullSafe(F.struct(*rest))).where(_RN).drop(_RN, POSITION))
