"""Hand-made cases from FIXTURES.md §3, layer by layer."""

from decimal import Decimal

from pyspark.sql import functions as F

from salesmart.operators import eda, marts, questions, quality, staging, star
from salesmart.operators.dedup import dedup
from salesmart.plans.warehouse import Warehouse
from salesmart.params import Params
from tests.builders import d, order, sources, ts


def _basic(spark, extra_orders=(), extra_items=(), extra_customers=()):
    orders = [order("o1", "c1"), order("o2", "c2", status="Delivered"), order("o3", "c3", bought=None),
              order("o4", "c4", status="canceled"), *extra_orders]
    items = [("o1", 1, "p1", d("10.00"), d("1.00")), ("o1", 2, "p2", d("5.00"), d("0.50")),
             ("o2", 1, "p1", d("7.00"), d("0.00")), ("o9", 1, "p1", d("1.00"), d("0.00")), *extra_items]
    customers = [("c1", "u1", "rio", "RJ"), ("c2", "u1", "sao paulo", "SP"), ("c3", "u2", "x", "MG"),
                 ("c4", "u3", "y", "BA"), *extra_customers]
    products = [("p1", "beleza"), ("p2", None), ("p3", "xyz")]
    translation = [("beleza", "health_beauty")]
    return sources(spark, orders, items, customers, products, translation)


def test_clean_orders_rules(spark):
    stg = staging.staging(_basic(spark))["stg_orders"]
    rows = {r.order_id: r for r in stg.collect()}
    assert set(rows) == {"o1"}  # 'Delivered' (case), null purchase and canceled dropped
    assert rows["o1"].delivery_days == 4 and rows["o1"].delivered_late == 0


def test_missing_delivery_is_kept_on_time(spark):
    src = _basic(spark, extra_orders=[order("o5", "c5", delivered=None)])
    row = staging.staging(src)["stg_orders"].where("order_id = 'o5'").first()
    assert row.delivered_late == 0 and row.delivery_days is None


def test_dedup_survivor_stable_across_partitioning(spark):
    rows = [("k", 1, "b"), ("k", 1, "a"), ("k", 2, "z"), ("j", 1, None), ("j", 1, "c")]
    df = spark.createDataFrame(rows, "k string, n int, v string")
    expected = sorted(dedup(df, ["k", "n"]).collect())
    for parts in (1, 3, 7):
        assert sorted(dedup(df.repartition(parts), ["k", "n"]).collect()) == expected
    assert ("j", 1, None) in [tuple(r) for r in expected]  # nulls first
    assert ("k", 1, "a") in [tuple(r) for r in expected]


def test_products_fill_and_translation(spark):
    w = Warehouse(_basic(spark))
    got = {r.product_key: (r.category_pt, r.category_en) for r in w.table("dim_products").collect()}
    assert got == {"p1": ("beleza", "health_beauty"), "p2": ("unknown", "unknown"), "p3": ("xyz", "unknown")}


def test_dim_customers_latest_and_people_without_delivered_orders(spark):
    src = _basic(spark, extra_orders=[order("o6", "c6", bought="2021-01-01 00:00")],
                 extra_customers=[("c6", "u1", "recife", "PE")])
    dim = {r.customer_key: (r.customer_city, r.customer_state) for r in Warehouse(src).table("dim_customers").collect()}
    assert dim["u1"] == ("recife", "PE")            # latest delivered order wins
    assert set(dim) == {"u1", "u2", "u3"}            # u2, u3 have no delivered order, still present


def test_fact_drops_orphans_and_counts_reasons(spark):
    src = _basic(spark, extra_orders=[order("o7", "c_missing")], extra_items=[("o7", 1, "p1", d("2.00"), d("0.00"))])
    w = Warehouse(src)
    fact = w.table("fact_order_items")
    assert sorted((r.order_id, r.order_item_id) for r in fact.collect()) == [("o1", 1), ("o1", 2)]
    acc = {(r.table_name, r.step): r.rows for r in w.row_accounting().collect()}
    assert acc[("order_items", "order_not_delivered_or_missing")] == 2   # o2 (status), o9 (no order)
    assert acc[("order_items", "order_without_customer")] == 1           # o7
    assert acc[("order_items", "in_fact")] == 2


def test_dim_dates_from_staging_orders(spark):
    src = _basic(spark, extra_orders=[order("o8", "c8", bought="2020-02-29 23:00")],
                 extra_customers=[("c8", "u8", "a", "AC")])
    dates = {r.date_key.isoformat(): r for r in Warehouse(src).table("dim_dates").collect()}
    assert set(dates) == {"2020-01-01", "2020-02-29"}   # o8 has no items, its date is still there
    r = dates["2020-02-29"]
    assert (r.year, r.month, r.month_name, r.quarter, r.year_month, r.day_of_week) == \
        (2020, 2, "February", 1, "2020-02", "Saturday")


def _fact(spark, rows):
    schema = ("order_id string, order_item_id int, customer_key string, product_key string, order_date_key date, "
              "price decimal(10,2), freight_value decimal(10,2), item_total decimal(10,2), delivery_days int, "
              "delivered_late int")
    return spark.createDataFrame(rows, schema)


def _line(oid, item, cust, prod, day, total, days=1, late=0):
    return (oid, item, cust, prod, ts(day + " 00:00").date(), d(total), d("0.00"), d(total), days, late)


def test_monthly_lag_skips_gap_and_zero_previous(spark):
    fact = _fact(spark, [_line("a", 1, "u", "p", "2016-10-05", "0.00"), _line("b", 1, "u", "p", "2016-12-05", "50.00"),
                         _line("c", 1, "v", "p", "2017-01-05", "100.00")])
    dates = star.dim_dates(fact.select(F.col("order_date_key").cast("timestamp_ntz").alias("order_purchase_timestamp")))
    m = {r.year_month: r for r in marts.mart_monthly_sales(fact, dates).collect()}
    assert m["2016-12"].prev_month_revenue == Decimal("0.00") and m["2016-12"].mom_growth_pct is None
    assert m["2017-01"].mom_growth_pct == Decimal("100.00")
    assert m["2016-10"].prev_month_revenue is None


def test_tier_boundaries(spark):
    fact = _fact(spark, [_line("a", 1, "h", "p", "2020-01-01", "500.00"), _line("b", 1, "m1", "p", "2020-01-01", "499.99"),
                         _line("c", 1, "m2", "p", "2020-01-01", "150.00"), _line("e", 1, "l", "p", "2020-01-01", "149.99")])
    tiers = {r.customer_key: r.value_tier for r in marts.mart_customer_value(fact).collect()}
    assert tiers == {"h": "High", "m1": "Medium", "m2": "Medium", "l": "Low"}


def test_q2_fewer_than_six_eligible_months_repeat(spark):
    rows = [(f"2020-0{i}", d(100 * i), d(100 * (i - 1)), d(10 * i)) for i in range(2, 6)]
    mart = spark.createDataFrame(rows, "year_month string, total_revenue decimal(20,2), prev_month_revenue "
                                       "decimal(20,2), mom_growth_pct decimal(38,2)")
    out = questions.q2_growth_extremes(mart, min_prev_revenue=0, n=3).collect()
    assert len(out) == 6
    best = {r.year_month for r in out if r.kind == "best"}
    worst = {r.year_month for r in out if r.kind == "worst"}
    assert best & worst


def test_q5_rank_ties_and_q3_exactly_n(spark):
    lines = [_line(f"o{i}", 1, f"u{i}", f"p{i}", "2020-01-01", str(v)) for i, v in
             enumerate([90, 80, 70, 70, 10], start=1)]
    fact = _fact(spark, lines)
    dim = spark.createDataFrame([(f"p{i}", "x", "cat") for i in range(1, 6)], "product_key string, category_pt string, "
                                                                               "category_en string")
    q5 = questions.q5_top_products(fact, dim, n=3).collect()
    assert len(q5) == 4 and sorted(r.rank_in_category for r in q5) == [1, 2, 3, 3]
    cv = marts.mart_customer_value(fact)
    assert questions.q3_top_customers(cv, n=3).count() == 3


def test_q6_counts_orders_not_lines(spark):
    fact = _fact(spark, [_line("a", i, "u1", "p", "2020-01-01", "1.00", late=1) for i in range(1, 4)]
                 + [_line("b", 1, "u2", "p", "2020-01-01", "1.00", late=0)])
    dim = spark.createDataFrame([("u1", "x", "S"), ("u2", "y", "S")], "customer_key string, customer_city string, "
                                                                        "customer_state string")
    r = questions.q6_worst_late_states(fact, dim, min_orders=1).first()
    assert (r.orders, r.late_orders, r.late_rate_pct) == (2, 1, Decimal("50.00"))


def test_q4_shares_and_ratio_of_sums(spark):
    fact = _fact(spark, [_line("a", 1, "u1", "p", "2020-01-01", "10.00"), _line("b", 1, "u1", "p", "2020-01-02", "20.00"),
                         _line("c", 1, "u2", "p", "2020-01-01", "40.00"), _line("e", 1, "u3", "p", "2020-01-01", "5.00")])
    got = {r.customer_type: r for r in questions.q4_repeat_vs_one_time(marts.mart_customer_value(fact)).collect()}
    assert got["repeat"].customers == 1 and got["repeat"].pct_of_customers == Decimal("33.33")
    assert got["repeat"].avg_spend_per_order == Decimal("15.00")
    assert got["one-time"].avg_lifetime_spend == Decimal("22.50")


def test_correlation_nulls_constant_and_single_row(spark):
    df = spark.createDataFrame([(1.0, 2.0, 7.0), (2.0, None, 7.0), (3.0, 5.0, 7.0), (4.0, 6.0, 7.0)],
                               "a double, b double, c double")
    cells = {(r.measure_x, r.measure_y): r.r for r in eda.eda_correlation(df, measures=("a", "b", "c")).collect()}
    assert cells[("a", "b")] == 0.995871 == cells[("b", "a")]
    assert cells[("a", "c")] is None and cells[("c", "c")] is None and cells[("a", "a")] == 1.0
    one = eda.eda_correlation(df.limit(1), measures=("a", "b")).collect()
    assert all(r.r is None for r in one)


def test_value_tiers_chart_order(spark):
    cv = spark.createDataFrame([("a", d("1.00"), "Low"), ("b", d("3.00"), "Low"), ("c", d("600.00"), "High")],
                               "customer_key string, total_spent decimal(20,2), value_tier string")
    got = {r.value_tier: (r.tier_order, r.customers, r.avg_spent) for r in eda.eda_value_tiers(cv).collect()}
    assert got == {"Low": (1, 2, 2.0), "High": (3, 1, 600.0)}


def test_pk_duplicates_with_null_parts(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, 3)], "a int, b int")
    assert quality.duplicates(df, ["a", "b"], "t").first().duplicate_rows == 1
    rep = quality.primary_key_report(df, ["a", "b"], "t").first()
    assert (rep.duplicate_keys, rep.excess_rows, rep.null_key_rows) == (1, 1, 2)


def test_foreign_key_orphans_ignore_null_keys(spark):
    child = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(1,)], "k int")
    assert [r.k for r in quality.foreign_key_orphans(child, parent, "k", "k").collect()] == [2]


def test_profile_lists_only_columns_with_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    got = {(r.metric, r.column_name): r.value for r in quality.profile(df, "t").collect()}
    assert got == {("rows", None): 2, ("nulls", "b"): 1}


def test_params_defaults_are_reference_values():
    p = Params()
    assert (p.high_tier_min, p.medium_tier_min, p.growth_min_prev_revenue, p.late_states_min_orders) == \
        (500, 150, 100_000, 100)


def test_star_tables_have_declared_types(spark):
    from salesmart.operators.schemas import conform, schema_mismatches, star_schemas
    w = Warehouse(_basic(spark))
    declared = star_schemas("string")
    for name in declared:
        assert schema_mismatches(w.table(name), declared[name]) == [], name
    # conform is the typed INSERT: by name, cast, and loud on overflow
    df = spark.createDataFrame([("a", 5, Decimal("123456789.12"))], "k string, n int, v decimal(12,2)")
    assert conform(df.select("k", "n"), [("n", "bigint"), ("k", "string")]).dtypes == [("n", "bigint"), ("k", "string")]
    import pytest
    with pytest.raises(Exception):
        conform(df, [("v", "decimal(10,2)")]).collect()
