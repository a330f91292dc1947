"""Small source-shaped frames for hand-made cases."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

ORDERS = ("order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz, "
          "order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz")
ITEMS = "order_id string, order_item_id int, product_id string, price decimal(10,2), freight_value decimal(10,2)"
CUSTOMERS = "customer_id string, customer_unique_id string, customer_city string, customer_state string"
PRODUCTS = "product_id string, product_category_name string"
TRANSLATION = "product_category_name string, product_category_name_english string"


def ts(s: str | None):
    return None if s is None else dt.datetime.fromisoformat(s)


def d(x) -> Decimal:
    return Decimal(str(x))


def order(oid, cid, status="delivered", bought="2020-01-01 10:00", delivered="2020-01-05 10:00",
          promised="2020-01-10 00:00"):
    return (oid, cid, status, ts(bought), ts(delivered), ts(promised))


def sources(spark, orders, items, customers, products, translation=()):
    return {
        "orders": spark.createDataFrame(list(orders), ORDERS),
        "order_items": spark.createDataFrame(list(items), ITEMS),
        "customers": spark.createDataFrame(list(customers), CUSTOMERS),
        "products": spark.createDataFrame(list(products), PRODUCTS),
        "category_translation": spark.createDataFrame(list(translation), TRANSLATION),
    }
