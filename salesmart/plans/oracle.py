"""Independent SQL statements (DuckDB dialect) for the differential check.

Each statement runs over the raw test views (``lineitem orders customer
nation part``) and rebuilds everything in a shared CTE prelude. They follow
latest address by ``arg_max``, the previous month by an ASOF join, ranks by
counting what is ahead, marts from one row per order, both growth extremes
from one ranked pass, correlations from ``corr``. Rounded values follow the
same exact half-away-from-zero rule on integers; money and ratios come out as
DOUBLE, counts as BIGINT, ranks and flags as INTEGER.
"""

from __future__ import annotations

from salesmart.params import FIXTURE_PARAMS, Params


def half_up(num: str, den: str, *, digits: int = 2, num_scale: int = 0, den_scale: int = 0,
            percent: bool = False) -> str:
    """SQL for round(num / den [* 100], digits) on exact integers, as DOUBLE."""
    shift = digits + den_scale - num_scale + (2 if percent else 0)
    n = f"CAST(({num}) * {10 ** num_scale} AS HUGEINT)"
    d = f"CAST(({den}) * {10 ** den_scale} AS HUGEINT)"
    if shift < 0:
        d, shift = f"({d} * {10 ** -shift})", 0
    q = f"((2 * abs({n}) * {10 ** shift} + abs({d})) // (2 * abs(NULLIF({d}, 0))))"
    signed = f"(CASE WHEN ({n} < 0) <> ({d} < 0) THEN -{q} ELSE {q} END)"
    return f"(CAST({signed} AS DOUBLE) / {10 ** digits}.0)"


def _first(table: str, keys: list[str], order: list[str]) -> str:
    by = ", ".join(f"{c} NULLS FIRST" for c in order)
    return (f"SELECT * EXCLUDE (rn__) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {', '.join(keys)} "
            f"ORDER BY {by}) AS rn__ FROM {table}) WHERE rn__ = 1")


ITEM_COLS = ["order_id", "order_item_id", "product_id", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity",
             "l_discount", "l_tax", "l_returnflag", "l_linestatus", "price", "freight_value"]
ORDER_COLS = ["order_id", "customer_id", "order_status", "order_purchase_timestamp",
              "order_delivered_customer_date", "order_estimated_delivery_date"]
CUSTOMER_COLS = ["customer_id", "customer_unique_id", "customer_city", "customer_state"]
PRODUCT_COLS = ["product_id", "product_category_name"]
TRANSLATION_COLS = ["product_category_name", "product_category_name_english"]
SOURCE_COLS = {
    "orders": ("src_orders", ORDER_COLS, ["order_id"]),
    "order_items": ("src_order_items", ITEM_COLS, ["order_id", "order_item_id"]),
    "customers": ("src_customers", CUSTOMER_COLS, ["customer_id"]),
    "products": ("src_products", PRODUCT_COLS, ["product_id"]),
    "category_translation": ("src_category_translation", TRANSLATION_COLS, ["product_category_name"]),
}


def prelude(p: Params) -> str:
    return f"""
WITH
src_order_items AS (
    SELECT l_orderkey AS order_id, CAST(l_linenumber AS INTEGER) AS order_item_id, l_partkey AS product_id,
           l_suppkey, l_shipdate, l_extendedprice, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus,
           CAST(l_extendedprice AS DECIMAL(10,2)) AS price,
           CAST(ROUND(CAST(l_extendedprice AS DECIMAL(10,2)) * CAST(l_tax AS DECIMAL(4,2)), 2) AS DECIMAL(10,2))
               AS freight_value
    FROM lineitem
),
dedup_items AS ({_first("src_order_items", ["order_id", "order_item_id"], ITEM_COLS[2:])}),
last_ship AS (SELECT order_id, MAX(l_shipdate) AS last_ship FROM dedup_items GROUP BY order_id),
src_orders AS (
    SELECT o.o_orderkey AS order_id, o.o_orderkey AS customer_id,
           CASE WHEN o.o_orderstatus = 'F' THEN 'delivered' ELSE o.o_orderstatus END AS order_status,
           o.o_orderdate + INTERVAL 12 HOUR AS order_purchase_timestamp,
           CASE WHEN o.o_orderkey % 97 = 0 THEN NULL
                ELSE s.last_ship + to_hours(CAST(o.o_orderkey % 24 AS BIGINT)) END AS order_delivered_customer_date,
           o.o_orderdate + INTERVAL 60 DAY AS order_estimated_delivery_date
    FROM orders o LEFT JOIN last_ship s ON s.order_id = o.o_orderkey
),
src_customers AS (
    SELECT o.o_orderkey AS customer_id, o.o_custkey AS customer_unique_id, o.o_orderpriority AS customer_city,
           n.n_name AS customer_state
    FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
),
src_products AS (SELECT p_partkey AS product_id, NULLIF(p_type, 'PROMO') AS product_category_name FROM part),
src_category_translation AS (
    SELECT DISTINCT p_type AS product_category_name, lower(p_type) AS product_category_name_english
    FROM part WHERE p_type IN ('ECONOMY', 'LARGE', 'MEDIUM', 'STANDARD')
),
stg_orders AS (
    SELECT *,
           CAST(floor(date_diff('microsecond', order_purchase_timestamp, order_delivered_customer_date)
                      / 86400000000.0) AS INTEGER) AS delivery_days,
           CASE WHEN order_delivered_customer_date > order_estimated_delivery_date THEN 1 ELSE 0 END AS delivered_late
    FROM ({_first("src_orders", ["order_id"], ORDER_COLS[1:])})
    WHERE order_status = '{p.delivered_status}' AND order_purchase_timestamp IS NOT NULL
),
stg_order_items AS (SELECT *, price + freight_value AS item_total FROM dedup_items),
stg_customers AS ({_first("src_customers", ["customer_id"], CUSTOMER_COLS[1:])}),
stg_products AS (
    SELECT product_id, COALESCE(product_category_name, '{p.unknown_category}') AS product_category_name
    FROM ({_first("src_products", ["product_id"], PRODUCT_COLS[1:])})
),
stg_category_translation AS ({_first("src_category_translation", ["product_category_name"], TRANSLATION_COLS[1:])}),
dim_customers AS (
    SELECT customer_key, seen.city AS customer_city, seen.state AS customer_state FROM (
        SELECT customer_unique_id AS customer_key,
               arg_max({{'city': customer_city, 'state': customer_state}},
                       (coalesce(epoch_us(order_purchase_timestamp), -1000000000000000000), customer_id)) AS seen
        FROM stg_customers LEFT JOIN stg_orders USING (customer_id) GROUP BY customer_unique_id)
),
dim_products AS (
    SELECT product_id AS product_key, product_category_name AS category_pt,
           ifnull((SELECT any_value(product_category_name_english) FROM stg_category_translation t
                   WHERE t.product_category_name = s.product_category_name), '{p.unknown_category}') AS category_en
    FROM stg_products s
),
dim_dates AS (
    SELECT DISTINCT date_trunc('day', order_purchase_timestamp)::DATE AS date_key,
           extract('year' FROM order_purchase_timestamp)::INTEGER AS year,
           extract('month' FROM order_purchase_timestamp)::INTEGER AS month,
           monthname(order_purchase_timestamp) AS month_name,
           extract('quarter' FROM order_purchase_timestamp)::INTEGER AS quarter,
           left(order_purchase_timestamp::VARCHAR, 7) AS year_month,
           dayname(order_purchase_timestamp) AS day_of_week
    FROM stg_orders
),
fact_order_items AS (
    SELECT order_id, order_item_id, customer_unique_id AS customer_key, product_id AS product_key,
           order_purchase_timestamp::DATE AS order_date_key, price, freight_value,
           item_total::DECIMAL(10,2) AS item_total, delivery_days, delivered_late
    FROM stg_customers JOIN stg_orders USING (customer_id) JOIN stg_order_items USING (order_id)
),
order_totals AS (
    SELECT order_id, customer_key, order_date_key, any_value(delivered_late) AS late, sum(item_total) AS spent
    FROM fact_order_items GROUP BY ALL
),
category_orders AS (
    SELECT category_en, order_id, count(*) AS lines, sum(item_total) AS revenue, sum(price) AS prices
    FROM fact_order_items JOIN dim_products USING (product_key) GROUP BY ALL
),
categories AS (
    SELECT category_en, sum(revenue) AS total_revenue, count(*) AS order_count, sum(lines) AS items_sold,
           sum(prices) AS prices
    FROM category_orders GROUP BY category_en
),
mart_sales_by_category AS (
    SELECT category_en, total_revenue, order_count, items_sold,
           {half_up("prices", "items_sold", num_scale=2)} AS avg_item_price,
           1 + (SELECT count(*) FROM categories ahead WHERE ahead.total_revenue > c.total_revenue) AS revenue_rank
    FROM categories c
),
months AS (
    SELECT year_month, sum(spent) AS total_revenue, count(*) AS order_count,
           len(list_distinct(list(customer_key))) AS unique_customers
    FROM order_totals JOIN dim_dates ON date_key = order_date_key GROUP BY year_month
),
mart_monthly_sales AS (
    SELECT now.year_month, now.total_revenue, now.order_count, now.unique_customers,
           ago.total_revenue AS prev_month_revenue,
           {half_up("now.total_revenue - ago.total_revenue", "ago.total_revenue", num_scale=2, den_scale=2,
                    percent=True)} AS mom_growth_pct
    FROM months now ASOF LEFT JOIN months ago ON now.year_month > ago.year_month
),
mart_customer_value AS (
    SELECT customer_key, sum(spent) AS total_spent, count(*) AS order_count,
           min(order_date_key) AS first_order_date, max(order_date_key) AS last_order_date,
           (max(order_date_key) - min(order_date_key))::INTEGER AS customer_tenure_days,
           ['Low', 'Medium', 'High'][1 + (sum(spent) >= {p.medium_tier_min})::INTEGER
                                       + (sum(spent) >= {p.high_tier_min})::INTEGER] AS value_tier
    FROM order_totals GROUP BY customer_key
)"""


def _tables(p: Params) -> dict[str, str]:
    dbl = lambda c: f"CAST({c} AS DOUBLE) AS {c}"
    return {
        "stg_orders": "SELECT * FROM stg_orders",
        "stg_order_items": "SELECT " + ", ".join(ITEM_COLS[:-2] + [dbl("price"), dbl("freight_value"),
                                                                   dbl("item_total")]) + " FROM stg_order_items",
        "stg_customers": "SELECT * FROM stg_customers",
        "stg_products": "SELECT * FROM stg_products",
        "stg_category_translation": "SELECT * FROM stg_category_translation",
        "dim_customers": "SELECT * FROM dim_customers",
        "dim_products": "SELECT * FROM dim_products",
        "dim_dates": "SELECT CAST(date_key AS TIMESTAMP) AS date_key, * EXCLUDE (date_key) FROM dim_dates",
        "fact_order_items": ("SELECT order_id, order_item_id, customer_key, product_key, "
                             "CAST(order_date_key AS TIMESTAMP) AS order_date_key, "
                             f"{dbl('price')}, {dbl('freight_value')}, {dbl('item_total')}, delivery_days, "
                             "delivered_late FROM fact_order_items"),
        "mart_sales_by_category": (f"SELECT category_en, {dbl('total_revenue')}, CAST(order_count AS BIGINT) AS "
                                   "order_count, CAST(items_sold AS BIGINT) AS items_sold, avg_item_price, "
                                   "CAST(revenue_rank AS INTEGER) AS revenue_rank FROM mart_sales_by_category"),
        "mart_monthly_sales": (f"SELECT year_month, {dbl('total_revenue')}, CAST(order_count AS BIGINT) AS order_count, "
                               "CAST(unique_customers AS BIGINT) AS unique_customers, "
                               f"{dbl('prev_month_revenue')}, mom_growth_pct FROM mart_monthly_sales"),
        "mart_customer_value": (f"SELECT customer_key, {dbl('total_spent')}, CAST(order_count AS BIGINT) AS order_count, "
                                "CAST(first_order_date AS TIMESTAMP) AS first_order_date, "
                                "CAST(last_order_date AS TIMESTAMP) AS last_order_date, customer_tenure_days, value_tier "
                                "FROM mart_customer_value"),
    }


def _questions(p: Params) -> dict[str, str]:
    return {
        "q1_top_categories": f"""
SELECT CAST(revenue_rank AS INTEGER) AS revenue_rank, category_en, CAST(total_revenue AS DOUBLE) AS total_revenue,
       {half_up("total_revenue", "(SELECT SUM(total_revenue) FROM mart_sales_by_category)", num_scale=2,
                den_scale=2, percent=True)} AS pct_of_total_revenue
FROM mart_sales_by_category
ORDER BY total_revenue DESC, category_en ASC NULLS LAST
LIMIT {p.top_categories_n}""",
        "q2_growth_extremes": f""",
places AS (
    SELECT *, row_number() OVER (ORDER BY mom_growth_pct DESC NULLS LAST, year_month) AS from_top,
              row_number() OVER (ORDER BY mom_growth_pct NULLS LAST, year_month) AS from_bottom
    FROM mart_monthly_sales WHERE prev_month_revenue >= {p.growth_min_prev_revenue}
)
SELECT kind, year_month, CAST(total_revenue AS DOUBLE) AS total_revenue,
       CAST(prev_month_revenue AS DOUBLE) AS prev_month_revenue, mom_growth_pct
FROM places, (VALUES ('best'), ('worst')) ends(kind)
WHERE if(kind = 'best', from_top, from_bottom) <= {p.growth_n}""",
        "q3_top_customers": f"""
SELECT CAST(row_number() OVER (ORDER BY total_spent DESC, customer_key) AS INTEGER) AS spend_rank,
       customer_key, CAST(total_spent AS DOUBLE) AS total_spent, CAST(order_count AS BIGINT) AS order_count, value_tier
FROM (FROM mart_customer_value ORDER BY total_spent DESC, customer_key LIMIT {p.top_customers_n})
ORDER BY spend_rank""",
        "q4_repeat_vs_one_time": f""",
buyers AS (
    SELECT order_count > 1 AS again, count(*) AS people, sum(total_spent) AS money, sum(order_count) AS bought
    FROM mart_customer_value GROUP BY again
)
SELECT if(again, 'repeat', 'one-time') AS customer_type, CAST(people AS BIGINT) AS customers,
       {half_up("people", "sum(people) OVER ()", percent=True)} AS pct_of_customers,
       {half_up("money", "bought", num_scale=2)} AS avg_spend_per_order,
       {half_up("money", "people", num_scale=2)} AS avg_lifetime_spend
FROM buyers ORDER BY customer_type""",
        "q5_top_products": f""",
sold AS (
    SELECT category_en, product_key, revenue, items_sold
    FROM (SELECT product_key, sum(item_total) AS revenue, count(*) AS items_sold FROM fact_order_items GROUP BY product_key)
    JOIN dim_products USING (product_key)
),
placed AS (SELECT *, (SELECT count(*) FROM sold ahead WHERE ahead.category_en = s.category_en
                      AND ahead.revenue > s.revenue) AS ahead FROM sold s)
SELECT category_en, CAST(ahead + 1 AS INTEGER) AS rank_in_category, product_key,
       CAST(revenue AS DOUBLE) AS revenue, CAST(items_sold AS BIGINT) AS items_sold
FROM placed WHERE ahead < {p.top_products_n}
ORDER BY category_en NULLS LAST, rank_in_category, product_key""",
        "q6_worst_late_states": f"""
SELECT customer_state, CAST(count(*) AS BIGINT) AS orders, CAST(sum(late) AS INTEGER) AS late_orders,
       {half_up("sum(late)", "count(*)", percent=True)} AS late_rate_pct
FROM order_totals JOIN dim_customers USING (customer_key)
GROUP BY customer_state HAVING count(*) >= {p.late_states_min_orders}
ORDER BY late_rate_pct DESC, customer_state NULLS LAST LIMIT {p.late_states_n}""",
    }


MEASURES = ["price", "freight_value", "item_total", "delivery_days"]


def _correlation() -> str:
    cells = [f"SELECT '{a}' AS measure_x, '{b}' AS measure_y, round(CAST("
             + (f"CASE WHEN min({a}) < max({a}) THEN 1 END" if a == b else f"corr({a}::DOUBLE, {b}::DOUBLE)")
             + " AS DOUBLE), 6) AS r FROM fact_order_items" for a in MEASURES for b in MEASURES]
    return "\n" + "\nUNION ALL\n".join(cells)


def _charts(p: Params) -> dict[str, str]:
    return {
        "eda_top_categories": f"""
SELECT category_en, CAST(total_revenue AS DOUBLE) AS total_revenue, CAST(total_revenue AS DOUBLE) / 1000.0 AS revenue_k
FROM mart_sales_by_category ORDER BY total_revenue DESC, category_en ASC NULLS LAST LIMIT {p.chart_top_categories_n}""",
        "eda_monthly_trend": """
SELECT year_month, CAST(total_revenue AS DOUBLE) AS total_revenue, CAST(total_revenue AS DOUBLE) / 1000.0 AS revenue_k
FROM mart_monthly_sales ORDER BY year_month""",
        "eda_value_tiers": """
SELECT CASE value_tier WHEN 'Low' THEN 1 WHEN 'Medium' THEN 2 WHEN 'High' THEN 3 END AS tier_order, value_tier,
       COUNT(*) AS customers, CAST(SUM(total_spent) AS DOUBLE) / COUNT(*) AS avg_spent
FROM mart_customer_value GROUP BY value_tier""",
        "eda_correlation": _correlation(),
    }


def _checks(p: Params) -> dict[str, str]:
    profile, dups = [], []
    for name, (tbl, cols, pk) in SOURCE_COLS.items():
        profile.append(f"SELECT '{name}' AS table_name, 'rows' AS metric, CAST(NULL AS VARCHAR) AS column_name, "
                       f"COUNT(*) AS value FROM {tbl}")
        profile += [f"SELECT '{name}', 'nulls', '{c}', COUNT(*) FILTER (WHERE {c} IS NULL) FROM {tbl}" for c in cols]
        dups.append(f"SELECT '{name}' AS table_name, '{','.join(pk)}' AS key_columns, "
                    f"CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS duplicate_rows "
                    f"FROM (SELECT COUNT(*) AS n FROM {tbl} GROUP BY {', '.join(pk)})")

    def pk_report(name: str, tbl: str, pk: list[str]) -> str:
        any_null = " OR ".join(f"{c} IS NULL" for c in pk)
        return (f"SELECT '{name}' AS table_name, '{','.join(pk)}' AS key_columns, "
                f"COUNT(*) FILTER (WHERE n > 1) AS duplicate_keys, CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS excess_rows, "
                f"CAST(COALESCE(SUM(CASE WHEN {any_null} THEN n END), 0) AS BIGINT) AS null_key_rows "
                f"FROM (SELECT {', '.join(pk)}, COUNT(*) AS n FROM {tbl} GROUP BY {', '.join(pk)})")

    def fk_report(child: str, parent: str, ck: str, pk_: str) -> str:
        return (f"SELECT '{child}' AS child_table, '{parent}' AS parent_table, '{ck}' AS key_column, COUNT(*) AS orphan_rows "
                f"FROM {child} x WHERE x.{ck} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} y WHERE y.{pk_} = x.{ck})")

    tables = ["stg_orders", "stg_order_items", "stg_customers", "stg_products", "stg_category_translation",
              "dim_customers", "dim_products", "dim_dates", "fact_order_items",
              "mart_sales_by_category", "mart_monthly_sales", "mart_customer_value"]
    st = p.delivered_status
    return {
        "qa_profile": "SELECT * FROM (" + "\nUNION ALL\n".join(profile) + ") WHERE metric = 'rows' OR value > 0",
        "qa_duplicates": "\nUNION ALL\n".join(dups),
        "check_primary_key": "\nUNION ALL\n".join([
            pk_report("order_items", "src_order_items", ["order_id", "order_item_id"]),
            pk_report("dim_customers", "dim_customers", ["customer_key"]),
            pk_report("dim_products", "dim_products", ["product_key"]),
            pk_report("dim_dates", "dim_dates", ["date_key"]),
            pk_report("fact_order_items", "fact_order_items", ["order_id", "order_item_id"]),
        ]),
        "check_foreign_keys": "\nUNION ALL\n".join([
            fk_report("fact_order_items", "dim_customers", "customer_key", "customer_key"),
            fk_report("fact_order_items", "dim_products", "product_key", "product_key"),
            fk_report("fact_order_items", "dim_dates", "order_date_key", "date_key"),
            fk_report("stg_order_items", "stg_orders", "order_id", "order_id"),
        ]),
        "row_accounting": f""",
o_first AS ({_first("src_orders", ["order_id"], ORDER_COLS[1:])}),
item_paths AS (
    SELECT o.customer_id AS o_customer, c.customer_id AS c_customer
    FROM stg_order_items i LEFT JOIN stg_orders o ON o.order_id = i.order_id
    LEFT JOIN stg_customers c ON c.customer_id = o.customer_id
)
SELECT 'orders' AS table_name, 'raw' AS step, CAST(COUNT(*) AS BIGINT) AS rows FROM src_orders
UNION ALL SELECT 'orders', 'after_dedup', COUNT(*) FROM o_first
UNION ALL SELECT 'orders', 'not_delivered', COUNT(*) FILTER (WHERE order_status IS DISTINCT FROM '{st}') FROM o_first
UNION ALL SELECT 'orders', 'null_purchase_time',
    COUNT(*) FILTER (WHERE order_status = '{st}' AND order_purchase_timestamp IS NULL) FROM o_first
UNION ALL SELECT 'order_items', 'raw', COUNT(*) FROM src_order_items
UNION ALL SELECT 'order_items', 'after_dedup', COUNT(*) FROM stg_order_items
UNION ALL SELECT 'order_items', 'order_not_delivered_or_missing', COUNT(*) FILTER (WHERE o_customer IS NULL) FROM item_paths
UNION ALL SELECT 'order_items', 'order_without_customer',
    COUNT(*) FILTER (WHERE o_customer IS NOT NULL AND c_customer IS NULL) FROM item_paths
UNION ALL SELECT 'order_items', 'in_fact', COUNT(*) FILTER (WHERE c_customer IS NOT NULL) FROM item_paths""",
        "star_join": """,
month_of AS (SELECT map_from_entries(list((date_key, year_month))) AS by_date FROM dim_dates),
whole AS (
    SELECT * FROM fact_order_items
    WHERE customer_key IN (SELECT customer_key FROM dim_customers)
      AND product_key IN (SELECT product_key FROM dim_products)
      AND order_date_key IN (SELECT date_key FROM dim_dates)
)
SELECT order_id, order_item_id, (SELECT by_date[order_date_key] FROM month_of) AS year_month,
       (SELECT max(category_en) FROM dim_products WHERE product_key = whole.product_key) AS category_en,
       (SELECT max(customer_state) FROM dim_customers WHERE customer_key = whole.customer_key) AS customer_state,
       CAST(item_total AS DOUBLE) AS item_total
FROM whole""",
        "table_row_counts": "\nUNION ALL\n".join(
            f"SELECT '{t}' AS table_name, CAST(COUNT(*) AS BIGINT) AS rows FROM {t}" for t in tables),
    }


def oracle_statements(p: Params = FIXTURE_PARAMS) -> dict[str, str]:
    """key -> one SQL statement. Bodies starting with ',' add CTEs to the prelude."""
    head = prelude(p)
    out = {}
    for key, body in {**_tables(p), **_questions(p), **_charts(p), **_checks(p)}.items():
        body = body.strip("\n")
        out[key] = head + body if body.startswith(",") else head + "\n" + body
    return out
