"""Source registry: file, primary key and typed columns per raw table (A4)."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class SourceSpec:
    name: str
    file_name: str
    pk: tuple[str, ...]
    # column -> Spark SQL type; only these are typed, other columns in the
    # file are carried along as strings.
    columns: dict[str, str] = field(default_factory=dict)


# The public dataset's file names and the columns the
# business rules read, with their types.
SOURCES: dict[str, SourceSpec] = {
    "orders": SourceSpec(
        "orders", "olist_orders_dataset.csv", ("order_id",),
        {
            "order_id": "string",
            "customer_id": "string",
            "order_status": "string",
            "order_purchase_timestamp": "timestamp_ntz",
            "order_delivered_customer_date": "timestamp_ntz",
            "order_estimated_delivery_date": "timestamp_ntz",
        },
    ),
    "order_items": SourceSpec(
        "order_items", "olist_order_items_dataset.csv", ("order_id", "order_item_id"),
        {
            "order_id": "string",
            "order_item_id": "int",
            "product_id": "string",
            "price": "decimal(10,2)",
            "freight_value": "decimal(10,2)",
        },
    ),
    "customers": SourceSpec(
        "customers", "olist_customers_dataset.csv", ("customer_id",),
        {
            "customer_id": "string",
            "customer_unique_id": "string",
            "customer_city": "string",
            "customer_state": "string",
        },
    ),
    "products": SourceSpec(
        "products", "olist_products_dataset.csv", ("product_id",),
        {"product_id": "string", "product_category_name": "string"},
    ),
    "category_translation": SourceSpec(
        "category_translation", "product_category_name_translation.csv", ("product_category_name",),
        {"product_category_name": "string", "product_category_name_english": "string"},
    ),
}
