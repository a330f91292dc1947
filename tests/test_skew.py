"""Hot keys: one order with a third of the item rows, one item key with many
copies, one person with a third of the customer rows. Results must be whole
and exact, and the fact join must take AQE's skew-split path."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from salesmart.plans.warehouse import Warehouse
from tests.builders import ITEMS, ORDERS, CUSTOMERS, PRODUCTS, TRANSLATION

N_ORDERS = 600
HOT_LINES = 1500          # lines of the hot order: about a third of all item rows
COPIES = 200              # copies of one (order, line) key


@pytest.fixture()
def skew_conf(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _sources(spark):
    base = dt.datetime(2020, 1, 1, 10)
    orders = [(f"o{i}", f"c{i}", "delivered", base + dt.timedelta(days=i % 90), base + dt.timedelta(days=i % 90 + 3),
               base + dt.timedelta(days=i % 90 + 10)) for i in range(N_ORDERS)]
    # A third of the customer rows belong to one person ("hot").
    customers = [(f"c{i}", "hot" if i % 3 == 0 else f"u{i}", f"city{i}", f"S{i % 5}") for i in range(N_ORDERS)]
    items = [(f"o{i}", 1, f"p{i % 50}", Decimal("10.00"), Decimal("1.00")) for i in range(N_ORDERS)]
    items += [("o7", line, "p0", Decimal("2.00"), Decimal("0.50")) for line in range(2, HOT_LINES + 2)]
    items += [("o8", 2, "p1", Decimal(f"{100 + c}.00"), Decimal("0.00")) for c in range(COPIES)]
    products = [(f"p{i}", "cat" if i < 25 else "other") for i in range(50)]
    return {
        "orders": spark.createDataFrame(orders, ORDERS),
        "order_items": spark.createDataFrame(items, ITEMS).repartition(8),
        "customers": spark.createDataFrame(customers, CUSTOMERS),
        "products": spark.createDataFrame(products, PRODUCTS),
        "category_translation": spark.createDataFrame([("cat", "category")], TRANSLATION),
    }


def test_hot_keys_whole_and_exact(spark, skew_conf):
    w = Warehouse(_sources(spark))
    fact = w.table("fact_order_items")
    rows = {(r.order_id, r.order_item_id): r for r in fact.collect()}
    plan = fact._jdf.queryExecution().executedPlan().toString()   # final adaptive plan
    assert "skew=true" in plan
    assert len(rows) == N_ORDERS + HOT_LINES + 1                 # copies collapse to one line
    assert rows[("o8", 2)].price == Decimal("100.00")            # first under the total order
    assert sum(1 for k in rows if k[0] == "o7") == HOT_LINES + 1

    dim = {r.customer_key: r for r in w.table("dim_customers").collect()}
    # Brute force: latest purchase of the hot person, ties to the larger customer_id.
    hot = [(i % 90, f"c{i}") for i in range(N_ORDERS) if i % 3 == 0]
    latest = max(hot)[0]
    winner = max(c for d, c in hot if d == latest)
    assert dim["hot"].customer_city == "city" + winner[1:]
    cv = {r.customer_key: r for r in w.table("mart_customer_value").collect()}
    assert cv["hot"].order_count == N_ORDERS // 3

    total = fact.agg(F.sum("item_total")).first()[0]
    cat = w.table("mart_sales_by_category").agg(F.sum("total_revenue")).first()[0]
    assert total == cat == Decimal("11") * N_ORDERS + Decimal("2.50") * HOT_LINES + Decimal("100.00")
    q5 = [r for r in w.question("q5_top_products").collect() if r.category_en == "category"]
    assert q5[0].product_key == "p0" and q5[0].rank_in_category == 1


def test_lines_without_an_order_do_not_meet_under_a_null_customer(spark, skew_conf):
    """Most lines belong to orders that were not delivered: they must be counted
    by their order and never be dealt by the customer they lack."""
    src = _sources(spark)
    # Two thirds not delivered, one order in 100 without a customer, one in 50 with an unknown one.
    n = F.substring("order_id", 2, 9).cast("int")
    customer = F.when(n % 100 == 0, None).when(n % 50 == 3, "nobody").otherwise(F.col("customer_id"))
    src["orders"] = src["orders"].withColumn("order_status", F.when(n % 3 == 0, "delivered").otherwise("lost")).withColumn("customer_id", customer)
    lost = [(None, 1, "p1", Decimal("1.00"), Decimal("0.00")), (None, 2, "p1", Decimal("1.00"), Decimal("0.00")), ("gone", 1, "p1", None, None)]
    src["order_items"] = src["order_items"].unionByName(spark.createDataFrame(lost, ITEMS))
    w = Warehouse(src)
    got = {r.step: r.rows for r in w.row_accounting().collect() if r.table_name == "order_items"}
    lines = {i: 1 + (HOT_LINES if i == 7 else 0) + (1 if i == 8 else 0) for i in range(N_ORDERS)}
    found = [i for i in range(N_ORDERS) if i % 3 == 0 and i % 100 != 0]
    no_customer = sum(lines[i] for i in found if i % 50 == 3)
    in_fact = sum(lines[i] for i in found) - no_customer
    assert got == {"raw": sum(lines.values()) + COPIES - 1 + 3, "after_dedup": sum(lines.values()) + 3, "order_without_customer": no_customer,
                   "in_fact": in_fact, "order_not_delivered_or_missing": sum(lines.values()) + 3 - no_customer - in_fact}
    plan = w.row_accounting()._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.split("\n") if "Join LeftOuter" in line and "order_items" not in line]
    depth = {("customer" if "c_id" in line else "order"): line.index("Join") for line in joins if "order_id" in line or "c_id" in line}
    assert depth["customer"] > depth["order"], plan  # orders meet customers below the lines
