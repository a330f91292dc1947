"""Declared star-schema types (A7, A9).

The star tables have fixed column types; ids take the sources' id type
(string from the raw CSV files, bigint in the test-data mapping).
:func:`conform` is the ``INSERT ... SELECT`` of a typed table: select by
name and cast, failing on a value the type cannot hold (ANSI).
:func:`schema_mismatches` checks a written table against its declaration
from metadata alone (no job).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def star_schemas(id_type: str = "string") -> dict[str, list[tuple[str, str]]]:
    """Table -> [(column, type)] in declared order; types are spelled as
    Spark's ``DataType.simpleString()``."""
    money = "decimal(10,2)"
    return {
        "dim_customers": [("customer_key", id_type), ("customer_city", "string"), ("customer_state", "string")],
        "dim_products": [("product_key", id_type), ("category_pt", "string"), ("category_en", "string")],
        "dim_dates": [("date_key", "date"), ("year", "int"), ("month", "int"), ("month_name", "string"),
                      ("quarter", "int"), ("year_month", "string"), ("day_of_week", "string")],
        "fact_order_items": [("order_id", id_type), ("order_item_id", "int"), ("customer_key", id_type),
                             ("product_key", id_type), ("order_date_key", "date"), ("price", money),
                             ("freight_value", money), ("item_total", money), ("delivery_days", "int"),
                             ("delivered_late", "int")],
    }


def conform(df: DataFrame, columns: list[tuple[str, str]]) -> DataFrame:
    """Select the declared columns by name, cast to their declared types."""
    return df.select(*[F.col(c).cast(t).alias(c) for c, t in columns])


def schema_mismatches(df: DataFrame, columns: list[tuple[str, str]]) -> list[str]:
    """Differences between a table's schema and its declaration."""
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    out = []
    for c, t in columns:
        if c not in have:
            out.append(f"missing {c}")
        elif have[c] != t:
            out.append(f"{c}: {have[c]} != {t}")
    extra = [c for c in have if c not in dict(columns)]
    return out + [f"undeclared {c}" for c in extra]
