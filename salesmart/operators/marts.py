"""Pre-aggregated marts (K8-K10). Money stays exact decimal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.functions.numeric import round_ratio
from salesmart.functions.time import calendar_days
from salesmart.params import Params

_DEFAULT = Params()
SALTS = 16  # tasks over which the orders of one product are dealt


def mart_sales_by_category(fact: DataFrame, dim_products: DataFrame) -> DataFrame:
    """Revenue, distinct orders, items and mean item price per English
    category, ranked by revenue (ties share a rank).

    Lines are summed per (product, order) before they meet the dimension, so a
    product in a third of all lines is one row per order there, dealt by a salt
    of the order. Then one row per (category, order) makes the distinct count
    a plain one. The rank window has no partition key, but it runs on the
    aggregate: one row per category.
    """
    per_order = fact.groupBy("product_key", "order_id").agg(
        F.sum("item_total").alias("revenue"), F.count(F.lit(1)).alias("items"), F.sum("price").alias("price_sum"))
    names = dim_products.select("product_key", "category_en", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])).alias("_salt"))
    j = (per_order.withColumn("_salt", F.pmod(F.xxhash64("order_id"), F.lit(SALTS)).cast("int"))
         .join(names, ["product_key", "_salt"]))
    once = j.groupBy("category_en", "order_id").agg(
        F.sum("revenue").alias("revenue"), F.sum("items").alias("items"), F.sum("price_sum").alias("price_sum"))
    g = once.groupBy("category_en").agg(
        F.sum("revenue").cast("decimal(20,2)").alias("total_revenue"),
        F.count(F.lit(1)).alias("order_count"),
        F.sum("items").alias("items_sold"),
        F.sum("price_sum").cast("decimal(20,2)").alias("price_sum"))
    return g.select(
        "category_en", "total_revenue", "order_count", "items_sold",
        round_ratio(F.col("price_sum"), F.col("items_sold"), num_scale=2).alias("avg_item_price"),
        F.rank().over(Window.orderBy(F.col("total_revenue").desc())).alias("revenue_rank"))


def mart_monthly_sales(fact: DataFrame, dim_dates: DataFrame) -> DataFrame:
    """Monthly revenue, distinct orders and people, previous month's revenue
    (previous *row*, so a missing month compares with the one before) and
    growth in percent, null when the previous revenue is 0 or absent.

    An order has one date and one customer, so its lines are summed first:
    the date dimension meets one row per order, and the two distinct counts
    become one ``count(*)`` and one distinct count, with no row-multiplying
    Expand.
    """
    per_order = fact.groupBy("order_date_key", "order_id", "customer_key").agg(
        F.sum("item_total").alias("order_revenue"))
    j = per_order.join(dim_dates.select(F.col("date_key").alias("order_date_key"), "year_month"), "order_date_key")
    monthly = j.groupBy("year_month").agg(
        F.sum("order_revenue").alias("total_revenue"),
        F.count(F.lit(1)).alias("order_count"),
        F.count_distinct("customer_key").alias("unique_customers"))
    prev = F.lag("total_revenue", 1).over(Window.orderBy("year_month"))
    with_prev = monthly.withColumn("prev_month_revenue", prev)
    growth = round_ratio(F.col("total_revenue") - F.col("prev_month_revenue"), F.col("prev_month_revenue"),
                         num_scale=2, den_scale=2, percent=True)
    return with_prev.select("year_month", "total_revenue", "order_count", "unique_customers",
                            "prev_month_revenue", growth.alias("mom_growth_pct"))


def mart_customer_value(fact: DataFrame, high: float = _DEFAULT.high_tier_min,
                        medium: float = _DEFAULT.medium_tier_min) -> DataFrame:
    """Lifetime spend, distinct orders, first/last order date, tenure in
    calendar days and a value tier per person (first matching tier wins,
    on the unrounded spend)."""
    g = fact.groupBy("customer_key").agg(
        F.sum("item_total").alias("total_spent"),
        F.count_distinct("order_id").alias("order_count"),
        F.min("order_date_key").alias("first_order_date"),
        F.max("order_date_key").alias("last_order_date"))
    spent = F.col("total_spent")
    tier = (F.when(spent >= F.lit(high), F.lit("High"))
            .when(spent >= F.lit(medium), F.lit("Medium"))
            .otherwise(F.lit("Low")))
    return g.select("customer_key", "total_spent", "order_count", "first_order_date", "last_order_date",
                    calendar_days(F.col("first_order_date"), F.col("last_order_date")).alias("customer_tenure_days"),
                    tier.alias("value_tier"))


def mart_builders(table: Callable[[str], DataFrame], params: Params = _DEFAULT) -> dict[str, Callable[[], DataFrame]]:
    """How each mart is built from the star tables ``table`` gives by name."""
    return {
        "mart_sales_by_category": lambda: mart_sales_by_category(table("fact_order_items"), table("dim_products")),
        "mart_monthly_sales": lambda: mart_monthly_sales(table("fact_order_items"), table("dim_dates")),
        "mart_customer_value": lambda: mart_customer_value(table("fact_order_items"), params.high_tier_min,
                                                           params.medium_tier_min),
    }


def marts(star: dict[str, DataFrame], params: Params = _DEFAULT) -> dict[str, DataFrame]:
    return {name: build() for name, build in mart_builders(star.__getitem__, params).items()}
