"""The six business questions (K11-K16).

Wherever the reference leaves ties to chance, the key is appended as the
last sort column, so the answer is the same on every run and partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.functions.numeric import round_ratio
from salesmart.params import Params

_DEFAULT = Params()


def q1_top_categories(mart_category: DataFrame, n: int = _DEFAULT.top_categories_n) -> DataFrame:
    """Top ``n`` categories by revenue with their share of all revenue.

    The grand total is a scalar subquery: computed once by a global
    aggregate and embedded as a value, no join.
    """
    total = mart_category.agg(F.sum("total_revenue")).scalar()
    pct = round_ratio(F.col("total_revenue"), F.col("all_revenue"), num_scale=2, den_scale=2, percent=True)
    # The share is computed per category *before* ordering, so the sort and
    # limit plan as one distributed top-n (TakeOrderedAndProject).
    return (mart_category.select("revenue_rank", "category_en", "total_revenue", total.alias("all_revenue"))
            .select("revenue_rank", "category_en", "total_revenue", pct.alias("pct_of_total_revenue"))
            .orderBy(F.col("total_revenue").desc(), F.col("category_en").asc_nulls_last())
            .limit(n))


def q2_growth_extremes(mart_monthly: DataFrame, min_prev_revenue: float = _DEFAULT.growth_min_prev_revenue,
                       n: int = _DEFAULT.growth_n) -> DataFrame:
    """The ``n`` best and ``n`` worst growth months among months whose
    previous month earned at least ``min_prev_revenue``. With fewer than
    ``2n`` eligible months a month can appear in both halves."""
    eligible = (mart_monthly.where(F.col("prev_month_revenue") >= F.lit(min_prev_revenue))
                .select("year_month", "total_revenue", "prev_month_revenue", "mom_growth_pct"))
    g, ym = F.col("mom_growth_pct"), F.col("year_month")
    best = eligible.orderBy(g.desc_nulls_last(), ym.asc()).limit(n)
    worst = eligible.orderBy(g.asc_nulls_last(), ym.asc()).limit(n)
    return (best.select(F.lit("best").alias("kind"), "*")
            .unionByName(worst.select(F.lit("worst").alias("kind"), "*")))


def q3_top_customers(mart_customer: DataFrame, n: int = _DEFAULT.top_customers_n) -> DataFrame:
    """Exactly ``n`` people by lifetime spend (row_number, not rank).

    The ``<= n`` filter sits next to the window, so Spark takes a
    distributed top-n before the single-partition window.
    """
    w = Window.orderBy(F.col("total_spent").desc(), F.col("customer_key").asc())
    ranked = mart_customer.select(F.row_number().over(w).alias("spend_rank"),
                                  "customer_key", "total_spent", "order_count", "value_tier")
    return ranked.where(F.col("spend_rank") <= n).orderBy("spend_rank")


def q4_repeat_vs_one_time(mart_customer: DataFrame) -> DataFrame:
    """Share of people with more than one order, and their spend per order
    (a ratio of sums) and lifetime spend, against one-time buyers."""
    kind = F.when(F.col("order_count") > 1, F.lit("repeat")).otherwise(F.lit("one-time"))
    g = (mart_customer.select(kind.alias("customer_type"), "total_spent", "order_count")
         .groupBy("customer_type")
         .agg(F.count(F.lit(1)).alias("customers"),
              F.sum("total_spent").alias("spent"),
              F.sum("order_count").alias("orders")))
    all_customers = F.sum("customers").over(Window.partitionBy())  # two rows
    return g.select(
        "customer_type", "customers",
        round_ratio(F.col("customers"), all_customers, percent=True).alias("pct_of_customers"),
        round_ratio(F.col("spent"), F.col("orders"), num_scale=2).alias("avg_spend_per_order"),
        round_ratio(F.col("spent"), F.col("customers"), num_scale=2).alias("avg_lifetime_spend")).orderBy("customer_type")


def q5_top_products(fact: DataFrame, dim_products: DataFrame, n: int = _DEFAULT.top_products_n) -> DataFrame:
    """Top ``n`` products per category by revenue; rank keeps ties, so a
    category can return more than ``n`` rows.

    The fact is aggregated per product *before* the join (a product has
    one category), so the join and the ranking see one row per product.
    """
    per_product = fact.groupBy("product_key").agg(
        F.sum("item_total").alias("revenue"), F.count(F.lit(1)).alias("items_sold"))
    j = per_product.join(dim_products.select("product_key", "category_en"), "product_key")
    w = Window.partitionBy("category_en").orderBy(F.col("revenue").desc())
    ranked = j.withColumn("rank_in_category", F.rank().over(w))
    return (ranked.where(F.col("rank_in_category") <= n)
            .select("category_en", "rank_in_category", "product_key", "revenue", "items_sold")
            .orderBy(F.col("category_en").asc_nulls_last(), "rank_in_category", "product_key"))


def q6_worst_late_states(fact: DataFrame, dim_customers: DataFrame,
                         min_orders: int = _DEFAULT.late_states_min_orders,
                         n: int = _DEFAULT.late_states_n) -> DataFrame:
    """States with the highest share of late orders among states with at
    least ``min_orders`` orders. Lateness is per order, so lines collapse
    to orders first; orders are then summed per person before the join
    with the person dimension, so the join sees one row per person."""
    orders = fact.select("order_id", "customer_key", "delivered_late").distinct()
    per_person = orders.groupBy("customer_key").agg(
        F.count(F.lit(1)).alias("n_orders"), F.sum("delivered_late").alias("n_late"))
    by_state = (per_person.join(dim_customers.select("customer_key", "customer_state"), "customer_key")
                .groupBy("customer_state")
                .agg(F.sum("n_orders").alias("orders"), F.sum("n_late").alias("late_orders"))
                .where(F.col("orders") >= F.lit(min_orders)))
    rate = round_ratio(F.col("late_orders"), F.col("orders"), percent=True)
    return (by_state.select("customer_state", "orders", F.col("late_orders").cast("int").alias("late_orders"),
                            rate.alias("late_rate_pct"))
            .orderBy(F.col("late_rate_pct").desc(), F.col("customer_state").asc_nulls_last())
            .limit(n))
