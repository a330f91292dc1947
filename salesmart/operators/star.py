"""Star schema: three dimensions around an order-line fact (K4-K7)."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.operators.dedup import first_per_key
from salesmart.operators.schemas import conform, star_schemas
from salesmart.operators.staging import PIECE
from salesmart.params import Params

_DEFAULT = Params()


def dim_customers(stg_customers: DataFrame, stg_orders: DataFrame) -> DataFrame:
    """One row per person: the city and state of their latest delivered
    order. People whose orders were all filtered out are kept (left join);
    their null timestamps sort last. Ties go to the larger customer_id."""
    c = stg_customers.select("customer_id", "customer_unique_id", "customer_city", "customer_state")
    o = stg_orders.select("customer_id", "order_purchase_timestamp")
    latest = first_per_key(
        c.join(o, "customer_id", "left"), ["customer_unique_id"],
        [F.col("order_purchase_timestamp").desc_nulls_last(), F.col("customer_id").desc_nulls_last()])
    return latest.select(F.col("customer_unique_id").alias("customer_key"), "customer_city", "customer_state")


def dim_products(stg_products: DataFrame, stg_translation: DataFrame,
                 fill: str = _DEFAULT.unknown_category) -> DataFrame:
    """``category_pt`` keeps the source name; ``category_en`` is its
    translation or ``fill``."""
    t = stg_translation.select("product_category_name", "product_category_name_english")
    return (stg_products.select("product_id", "product_category_name")
            .join(t, "product_category_name", "left")
            .select(F.col("product_id").alias("product_key"),
                    F.col("product_category_name").alias("category_pt"),
                    F.coalesce(F.col("product_category_name_english"), F.lit(fill)).alias("category_en")))


def dim_dates(stg_orders: DataFrame) -> DataFrame:
    """Calendar attributes of every date with a delivered order (from
    staging, so dates of orders without items are included)."""
    d = stg_orders.select(F.col("order_purchase_timestamp").cast("date").alias("date_key")).distinct()
    k = F.col("date_key")
    return d.select(k,
                    F.year(k).alias("year"),
                    F.month(k).alias("month"),
                    F.date_format(k, "MMMM").alias("month_name"),
                    F.quarter(k).alias("quarter"),
                    F.date_format(k, "yyyy-MM").alias("year_month"),
                    F.date_format(k, "EEEE").alias("day_of_week"))


def fact_order_items(stg_items: DataFrame, stg_orders: DataFrame, stg_customers: DataFrame) -> DataFrame:
    """One row per order line of a delivered order with a known customer.

    Orders meet customers first (order-sized join), then the items by
    ``order_id``. Items stored by (order, piece) are read as they lie: what is
    shuffled is one row per order and piece. Order-level measures repeat on
    every line of the order.
    """
    orders = (stg_orders.select("order_id", "customer_id", "order_purchase_timestamp",
                                "delivery_days", "delivered_late")
              .join(stg_customers.select("customer_id", "customer_unique_id"), "customer_id"))
    items = stg_items.select("order_id", "order_item_id", "product_id", "price", "freight_value", "item_total",
                             *[c for c in stg_items.columns if c == PIECE])
    keys = ["order_id"]
    if PIECE in items.columns:
        keys.append(PIECE)
        orders = items.select(*keys).distinct().join(orders, "order_id")
    return (items.join(orders, keys)
            .select("order_id",
                    "order_item_id",
                    F.col("customer_unique_id").alias("customer_key"),
                    F.col("product_id").alias("product_key"),
                    F.col("order_purchase_timestamp").cast("date").alias("order_date_key"),
                    "price", "freight_value", "item_total", "delivery_days", "delivered_late"))


def star_builders(stg: Mapping[str, DataFrame], params: Params = _DEFAULT) -> dict[str, Callable[[], DataFrame]]:
    """How each star table is built from the staging tables, in its declared
    column types; called lazily, so callers may build them side by side."""
    declared = star_schemas(dict(stg["stg_orders"].dtypes)["order_id"])
    plans = {
        "dim_customers": lambda: dim_customers(stg["stg_customers"], stg["stg_orders"]),
        "dim_products": lambda: dim_products(stg["stg_products"], stg["stg_category_translation"],
                                             params.unknown_category),
        "dim_dates": lambda: dim_dates(stg["stg_orders"]),
        "fact_order_items": lambda: fact_order_items(stg["stg_order_items"], stg["stg_orders"], stg["stg_customers"]),
    }
    return {name: (lambda name=name, plan=plan: conform(plan(), declared[name])) for name, plan in plans.items()}


def star(stg: Mapping[str, DataFrame], params: Params = _DEFAULT) -> dict[str, DataFrame]:
    return {name: build() for name, build in star_builders(stg, params).items()}
