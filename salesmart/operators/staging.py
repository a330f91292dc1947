"""Cleaning rules: raw source -> staging table (K1-K3b).

Each ``clean_*`` deduplicates a source on its key (:func:`dedup_source`),
then applies that source's rules. The pipeline composes the two steps
itself (:func:`apply_rules`) so it can count rows between them without
another pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.functions.time import elapsed_days, late_flag
from salesmart.operators.dedup import clustered_first, dedup
from salesmart.params import Params
from salesmart.sources.specs import SOURCES

_DEFAULT = Params()


def dedup_source(name: str, df: DataFrame) -> DataFrame:
    """Rule 1 for every source: drop repeats of its primary key."""
    return dedup(df, SOURCES[name].pk)


# Lines of one order that stand together in the stored items. An order's lines
# are dealt by (order, piece), so that an order with a third of all lines is
# spread over as many pieces as it has, and all others stay whole.
PIECE = "_piece"
PIECE_LINES = 64


def clustered_items(items: DataFrame, rows: int, partitions: int) -> DataFrame:
    """Rule 1 for ``rows`` items, dealt by (order, piece) as they are stored."""
    piece = F.call_function("div", F.col("order_item_id"), F.lit(PIECE_LINES))
    pieces = items.withColumn(PIECE, F.coalesce(piece, F.lit(-1)).cast("long"))
    return clustered_first(pieces, SOURCES["order_items"].pk, ("order_id", PIECE), rows, partitions)


def _orders_rules(orders: DataFrame, status: str) -> DataFrame:
    o = orders.where(F.col("order_status") == F.lit(status)).dropna(subset=["order_purchase_timestamp"])
    return (o.withColumn("delivery_days", elapsed_days(F.col("order_purchase_timestamp"),
                                                       F.col("order_delivered_customer_date")))
             .withColumn("delivered_late", late_flag(F.col("order_delivered_customer_date"),
                                                     F.col("order_estimated_delivery_date"))))


def _items_rules(items: DataFrame) -> DataFrame:
    return items.withColumn("item_total", F.col("price") + F.col("freight_value"))


def _products_rules(products: DataFrame, fill: str) -> DataFrame:
    return products.fillna({"product_category_name": fill})


def clean_orders(orders: DataFrame, status: str = _DEFAULT.delivered_status) -> DataFrame:
    """Dedup on the key, keep delivered orders with a purchase time, add
    ``delivery_days`` (floored elapsed days) and ``delivered_late`` (0/1)."""
    return _orders_rules(dedup_source("orders", orders), status)


def clean_items(items: DataFrame) -> DataFrame:
    """Dedup on (order, line); ``item_total`` = price + freight, exact."""
    return _items_rules(dedup_source("order_items", items))


def clean_products(products: DataFrame, fill: str = _DEFAULT.unknown_category) -> DataFrame:
    """Dedup on the key; a missing category becomes ``fill``."""
    return _products_rules(dedup_source("products", products), fill)


def clean_customers(customers: DataFrame) -> DataFrame:
    """Dedup only: people without a delivered order stay."""
    return dedup_source("customers", customers)


def clean_translation(translation: DataFrame) -> DataFrame:
    return dedup_source("category_translation", translation)


STAGING_NAMES = {
    "orders": "stg_orders", "order_items": "stg_order_items", "customers": "stg_customers",
    "products": "stg_products", "category_translation": "stg_category_translation",
}


def apply_rules(name: str, deduped: DataFrame, params: Params = _DEFAULT) -> DataFrame:
    """The rules after the dedup, for callers that dedup themselves."""
    if name == "orders":
        return _orders_rules(deduped, params.delivered_status)
    if name == "order_items":
        return _items_rules(deduped)
    if name == "products":
        return _products_rules(deduped, params.unknown_category)
    return deduped


def staging(sources: dict[str, DataFrame], params: Params = _DEFAULT) -> dict[str, DataFrame]:
    """All five staging tables, keyed ``stg_<source>``."""
    return {STAGING_NAMES[name]: apply_rules(name, dedup_source(name, df), params)
            for name, df in sources.items()}
