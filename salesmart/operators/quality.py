"""Data-quality checks as Spark jobs (B1-B10).

Each check is a lazy DataFrame; the pipeline runs it and raises on a
violation. Counting never collects rows: only the one-row (or one row per
table) summaries reach the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.operators.dedup import dedup
from salesmart.operators.staging import PIECE
from salesmart.sources.specs import SOURCES


class QualityError(ValueError):
    """A gate or a declared constraint failed."""


def union_all(frames: list[DataFrame]) -> DataFrame:
    """UNION ALL by column name."""
    return reduce(DataFrame.unionByName, frames)


def profile(df: DataFrame, table_name: str) -> DataFrame:
    """Row count plus null count of every column that has nulls (B1, B2).

    One pass over the table; the wide one-row result is unpivoted to
    (table_name, metric, column_name, value).
    """
    aggs = [F.count(F.lit(1)).alias("__rows")]
    aggs += [F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)]
    wide = df.agg(*aggs)
    cells = [F.struct(F.lit("rows").alias("metric"), F.lit(None).cast("string").alias("column_name"),
                      F.col("__rows").alias("value"))]
    cells += [F.struct(F.lit("nulls").alias("metric"), F.lit(c).alias("column_name"), F.col(f"n{i}").alias("value"))
              for i, c in enumerate(df.columns)]
    long = wide.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")
    return (long.where((F.col("metric") == "rows") | (F.col("value") > 0))
            .select(F.lit(table_name).alias("table_name"), "metric", "column_name", "value"))


def key_counts(df: DataFrame, pk: Sequence[str]) -> DataFrame:
    """Rows per primary-key value; nulls form a group like any value."""
    return df.groupBy(*pk).agg(F.count(F.lit(1)).alias("rows"))


def duplicates(df: DataFrame, pk: Sequence[str], table_name: str) -> DataFrame:
    """Rows beyond the first on each key (B3)."""
    return (key_counts(df, pk).agg(F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)).alias("duplicate_rows"))
            .select(F.lit(table_name).alias("table_name"), F.lit(",".join(pk)).alias("key_columns"),
                    F.col("duplicate_rows").cast("bigint").alias("duplicate_rows")))


def primary_key_report(df: DataFrame, pk: Sequence[str], table_name: str) -> DataFrame:
    """One row: repeated keys, rows beyond the first, rows with a null key part."""
    any_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in pk])
    g = key_counts(df, pk).agg(
        F.count_if(F.col("rows") > 1).alias("duplicate_keys"),
        F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)).cast("bigint").alias("excess_rows"),
        F.coalesce(F.sum(F.when(any_null, F.col("rows"))), F.lit(0)).cast("bigint").alias("null_key_rows"))
    return g.select(F.lit(table_name).alias("table_name"), F.lit(",".join(pk)).alias("key_columns"),
                    "duplicate_keys", "excess_rows", "null_key_rows")


def foreign_key_orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose non-null key has no parent row (B8); a null key is
    legal. An anti join ignores repeated parent keys, so no distinct."""
    p = parent.select(F.col(parent_key).alias("__fk"))
    return child.where(F.col(child_key).isNotNull()).join(p, F.col(child_key) == F.col("__fk"), "left_anti")


def foreign_key_report(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str,
                       child_name: str, parent_name: str) -> DataFrame:
    orphans = foreign_key_orphans(child, parent, child_key, parent_key).agg(F.count(F.lit(1)).alias("orphan_rows"))
    return orphans.select(F.lit(child_name).alias("child_table"), F.lit(parent_name).alias("parent_table"),
                          F.lit(child_key).alias("key_column"), "orphan_rows")


def fact_integrity(fact: DataFrame, parents: Sequence[tuple[str, DataFrame, str]], fact_name: str) -> DataFrame:
    """The fact's references (B8) and the star join's survivors (B10) from one
    scan of its keys: (child_table, parent_table, key_column, orphan_rows,
    null_rows, joined_rows), a row per parent of ``parents`` (key of the fact,
    parent, key of the parent). ``joined_rows``, the same on each, counts fact
    rows that find all their parents.

    Parents are narrowed to one row per key, which a parent whose key is
    unique already has, so the left joins keep the fact's rows one to one."""
    keys = list(dict.fromkeys(key for key, _, _ in parents))
    rows, found = fact.select(*keys), []
    for i, (key, parent, parent_key) in enumerate(parents):
        known = parent.select(F.col(parent_key).alias(key)).where(F.col(key).isNotNull()).distinct().withColumn(f"__in{i}", F.lit(True))
        rows = rows.join(known, key, "left")
        found.append(F.coalesce(F.col(f"__in{i}"), F.lit(False)))
    counts = [F.count_if(reduce(lambda a, b: a & b, found)).alias("__joined")]
    for i, (key, _, _) in enumerate(parents):
        counts += [F.count_if(F.col(key).isNotNull() & ~found[i]).alias(f"__o{i}"), F.count_if(F.col(key).isNull()).alias(f"__n{i}")]
    cells = [F.struct(F.lit(key).alias("key_column"), F.col(f"__o{i}").alias("orphan_rows"), F.col(f"__n{i}").alias("null_rows"),
                      F.lit(i).alias("parent")) for i, (key, _, _) in enumerate(parents)]
    return (rows.agg(*counts).select("__joined", F.explode(F.array(*cells)).alias("c"))
            .select(F.lit(fact_name).alias("child_table"), "c.parent", "c.key_column", "c.orphan_rows", "c.null_rows",
                    F.col("__joined").alias("joined_rows")))


def star_join(fact: DataFrame, dim_customers: DataFrame, dim_products: DataFrame, dim_dates: DataFrame) -> DataFrame:
    """The fact joined to all three dimensions (B10); as many rows as the
    fact when every key resolves."""
    return (fact.select("order_id", "order_item_id", "customer_key", "product_key", "order_date_key", "item_total")
            .join(dim_customers.select("customer_key", "customer_state"), "customer_key")
            .join(dim_products.select("product_key", "category_en"), "product_key")
            .join(dim_dates.select(F.col("date_key").alias("order_date_key"), "year_month"), "order_date_key")
            .select("order_id", "order_item_id", "year_month", "category_en", "customer_state", "item_total"))


def _steps(one_row: DataFrame, table_name: str, steps: list[tuple[str, str]]) -> DataFrame:
    """Unpivot a one-row count summary into (table_name, step, rows)."""
    cells = [F.struct(F.lit(step).alias("step"), F.col(c).cast("bigint").alias("rows")) for step, c in steps]
    return (one_row.select(F.explode(F.array(*cells)).alias("cell"))
            .select(F.lit(table_name).alias("table_name"), "cell.step", "cell.rows"))


def order_steps(first_orders: DataFrame, delivered_status: str) -> DataFrame:
    """One row: deduplicated orders, and those the cleaning rules drop."""
    status = F.lit(delivered_status)
    return first_orders.agg(
        F.count(F.lit(1)).alias("kept"),
        F.count_if(F.coalesce(F.col("order_status") != status, F.lit(True))).alias("not_delivered"),
        F.count_if((F.col("order_status") == status) & F.col("order_purchase_timestamp").isNull())
         .alias("no_purchase_time"))


def lines_without_customer(stg_items: DataFrame, stg_orders: DataFrame, stg_customers: DataFrame) -> DataFrame:
    """One row: lines of delivered orders that have no customer row. Orders
    meet customers first; lines are counted per order where they are stored."""
    lost = stg_orders.select("order_id", "customer_id").join(stg_customers.select("customer_id"), "customer_id", "left_anti")
    keys = [c for c in ("order_id", PIECE) if c in stg_items.columns]
    lines = stg_items.groupBy(*keys).agg(F.count(F.lit(1)).alias("lines"))
    return (lines.join(lost.select("order_id"), "order_id")
            .agg(F.coalesce(F.sum("lines"), F.lit(0)).cast("bigint").alias("lines")))


def line_paths(stg_items: DataFrame, stg_orders: DataFrame, stg_customers: DataFrame) -> DataFrame:
    """One row: lines without a delivered order (or one that names no customer),
    without its customer row, and with both. Orders meet customers first, and
    lines come as a count per order: joined one by one, all lines without an
    order would meet under a null customer, in one task."""
    people = stg_customers.select(F.col("customer_id").alias("c_id"))
    orders = (stg_orders.select("order_id", "customer_id").where(F.col("customer_id").isNotNull())
              .join(people, F.col("customer_id") == F.col("c_id"), "left"))
    lines = stg_items.groupBy("order_id").agg(F.count(F.lit(1)).alias("lines")).join(orders, "order_id", "left")

    def counted(which: Column) -> Column:
        return F.coalesce(F.sum(F.when(which, F.col("lines"))), F.lit(0)).cast("bigint")

    return lines.agg(
        counted(F.col("customer_id").isNull()).alias("no_delivered_order"),
        counted(F.col("customer_id").isNotNull() & F.col("c_id").isNull()).alias("no_customer"),
        counted(F.col("c_id").isNotNull()).alias("in_fact"))


def row_accounting(sources: dict[str, DataFrame], stg: dict[str, DataFrame], delivered_status: str) -> DataFrame:
    """Where the rows went between the raw sources and the fact (B9):
    (table_name, step, rows). Items lost because their order was not
    delivered and items lost because the order has no customer row are
    reported separately."""
    o_src, i_src = sources["orders"], sources["order_items"]
    o_stats = order_steps(dedup(o_src, SOURCES["orders"].pk), delivered_status)
    o_raw = o_src.agg(F.count(F.lit(1)).alias("raw"))
    i_raw = i_src.agg(F.count(F.lit(1)).alias("raw"))
    i_kept = stg["stg_order_items"].agg(F.count(F.lit(1)).alias("kept"))
    i_stats = line_paths(stg["stg_order_items"], stg["stg_orders"], stg["stg_customers"])
    return union_all([
        _steps(o_raw, "orders", [("raw", "raw")]),
        _steps(o_stats, "orders", [("after_dedup", "kept"), ("not_delivered", "not_delivered"),
                                   ("null_purchase_time", "no_purchase_time")]),
        _steps(i_raw, "order_items", [("raw", "raw")]),
        _steps(i_kept, "order_items", [("after_dedup", "kept")]),
        _steps(i_stats, "order_items", [("order_not_delivered_or_missing", "no_delivered_order"),
                                        ("order_without_customer", "no_customer"), ("in_fact", "in_fact")]),
    ])


def preview(df: DataFrame, n: int = 5, order_by: Sequence[str] | None = None) -> DataFrame:
    """First ``n`` rows for eyeballing (A12). Ordered by ``order_by`` (all
    columns by default) so the preview is the same on every run; planned
    as a distributed top-n."""
    cols = list(order_by) if order_by else df.columns
    return df.orderBy(*[F.col(f"`{c}`").asc_nulls_last() for c in cols]).limit(n)
