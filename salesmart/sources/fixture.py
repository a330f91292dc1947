"""Map the TPC-H-shaped test tables onto the five source shapes (FIXTURES.md §2).

The mapping is itself a Spark job over the whole tables. Ids stay
``bigint``; the transforms do not depend on the id type. Nulls and
intraday times are injected by rule so the cleaning rules are exercised.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.functions.numeric import money
from salesmart.operators.dedup import dedup

# Fixture rules.
DELIVERED_CODE = "F"
PROMO_TYPE = "PROMO"
TRANSLATED_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "STANDARD")
NULL_DELIVERY_MODULUS = 97
PURCHASE_HOUR = 12
PROMISED_DAYS = 60

# Items carry these raw columns after the key, in this order; the remaining
# columns in schema order are the dedup tie-break (a total order here).
ITEM_CARRIED = ("l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity",
                "l_discount", "l_tax", "l_returnflag", "l_linestatus")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def items_source(lineitem: DataFrame) -> DataFrame:
    price = money(F.col("l_extendedprice"))
    freight = money(F.round(price * F.col("l_tax").cast("decimal(4,2)"), 2))
    return lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").cast("int").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        *ITEM_CARRIED,
        price.alias("price"),
        freight.alias("freight_value"),
    )


def orders_source(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Delivery time = last ship time of the order's deduplicated items plus
    ``orderkey % 24`` hours; null for every 97th order and orders without items."""
    last_ship = (dedup(items, ["order_id", "order_item_id"])
                 .groupBy("order_id").agg(F.max("l_shipdate").alias("last_ship")))
    key = F.col("o_orderkey")
    delivered = F.when(key % NULL_DELIVERY_MODULUS == 0, F.lit(None)).otherwise(
        F.timestamp_add("HOUR", key % 24, F.col("last_ship")))
    return (orders.join(last_ship, orders.o_orderkey == last_ship.order_id, "left")
            .select(key.alias("order_id"),
                    key.alias("customer_id"),
                    F.when(F.col("o_orderstatus") == DELIVERED_CODE, F.lit("delivered"))
                     .otherwise(F.col("o_orderstatus")).alias("order_status"),
                    F.timestamp_add("HOUR", F.lit(PURCHASE_HOUR), F.col("o_orderdate"))
                     .alias("order_purchase_timestamp"),
                    delivered.alias("order_delivered_customer_date"),
                    F.timestamp_add("DAY", F.lit(PROMISED_DAYS), F.col("o_orderdate"))
                     .alias("order_estimated_delivery_date")))


def customers_source(orders: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    """One customer row per order (a fresh id per order); the person is the
    TPC-H customer, the city varies per order, the state is the nation."""
    c = customer.select("c_custkey", "c_nationkey")
    n = nation.select("n_nationkey", "n_name")
    return (orders.select("o_orderkey", "o_custkey", "o_orderpriority")
            .join(c, orders.o_custkey == c.c_custkey, "left")
            .join(n, F.col("c_nationkey") == n.n_nationkey, "left")
            .select(F.col("o_orderkey").alias("customer_id"),
                    F.col("o_custkey").alias("customer_unique_id"),
                    F.col("o_orderpriority").alias("customer_city"),
                    F.col("n_name").alias("customer_state")))


def products_source(part: DataFrame) -> DataFrame:
    return part.select(F.col("p_partkey").alias("product_id"),
                       F.nullif(F.col("p_type"), F.lit(PROMO_TYPE)).alias("product_category_name"))


def translation_source(part: DataFrame) -> DataFrame:
    """One row per translated part type present in ``part``, English = lower case.
    A distinct over one low-cardinality column: partial aggregation leaves a
    handful of rows per task to shuffle."""
    t = F.col("p_type")
    return (part.select(t).where(t.isin(*TRANSLATED_TYPES)).distinct()
            .select(t.alias("product_category_name"), F.lower(t).alias("product_category_name_english")))


def fixture_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The five raw sources, shaped like the reference's inputs."""
    items = items_source(table(spark, sf_dir, "lineitem"))
    orders = table(spark, sf_dir, "orders")
    part = table(spark, sf_dir, "part")
    return {
        "orders": orders_source(orders, items),
        "order_items": items,
        "customers": customers_source(orders, table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")),
        "products": products_source(part),
        "category_translation": translation_source(part),
    }
