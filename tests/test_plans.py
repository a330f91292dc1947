"""Plan-shape assertions and whole-table properties."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from salesmart.plans.registry import REGISTRY
from salesmart.params import Params
from salesmart.plans.pipeline import rebuild
from salesmart.plans.warehouse import Warehouse
from salesmart.sources.fixture import fixture_sources
from tests.conftest import SF001

SMALL = Params(high_tier_min=1_300_000, medium_tier_min=700_000, growth_min_prev_revenue=0, late_states_min_orders=1)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def written(spark):
    report = rebuild(spark, fixture_sources(spark, SF001), SMALL, answers=False)
    return Warehouse.from_written(spark, report.out_dir, SMALL)


@pytest.mark.parametrize("key", sorted(REGISTRY))
def test_no_pairwise_joins(spark, key):
    p = plan(E.queries()[key](spark, SF001))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


@pytest.mark.parametrize("key", ["q1_top_categories", "q2_growth_extremes", "q3_top_customers",
                                 "q6_worst_late_states", "eda_top_categories"])
def test_top_n_is_distributed(written, key):
    df = written.question(key) if key.startswith("q") else written.chart(key)
    p = plan(df)
    assert "TakeOrderedAndProject" in p and "rangepartitioning" not in p


def test_dedup_limits_before_the_shuffle(spark):
    p = plan(E.queries()["stg_order_items"](spark, SF001))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_q5_rank_limit_is_partial(written):
    p = plan(written.question("q5_top_products"))
    assert "WindowGroupLimit" in p


def test_monthly_mart_has_no_expand(written):
    assert "Expand" not in plan(written.table("mart_monthly_sales"))


def test_filters_and_columns_reach_the_scan(written):
    q2 = plan(written.question("q2_growth_extremes"))
    assert "PushedFilters: [IsNotNull(prev_month_revenue), GreaterThanOrEqual(prev_month_revenue" in q2
    q6 = plan(written.question("q6_worst_late_states"))
    assert "ReadSchema: struct<order_id:bigint,customer_key:bigint,delivered_late:int>" in q6


def test_q1_total_is_one_subquery(written):
    p = plan(written.question("q1_top_categories"))
    assert len(set(__import__("re").findall(r"Subquery subquery#\d+", p))) == 1


def _one(df, col):
    return df.agg(F.sum(col).alias("v")).first().v


def test_revenue_totals_agree(written):
    fact_total = _one(written.table("fact_order_items"), "item_total")
    assert _one(written.table("mart_sales_by_category"), "total_revenue") == fact_total
    assert _one(written.table("mart_monthly_sales"), "total_revenue") == fact_total
    assert _one(written.table("mart_customer_value"), "total_spent") == fact_total


def test_counts_agree(written):
    fact = written.table("fact_order_items")
    assert _one(written.table("mart_sales_by_category"), "items_sold") == fact.count()
    cv = written.table("mart_customer_value")
    assert _one(written.chart("eda_value_tiers"), "customers") == cv.count()
    assert _one(written.question("q4_repeat_vs_one_time"), "customers") == cv.count()
    assert written.star_join().count() == fact.count()
    assert _one(written.table("mart_monthly_sales"), "order_count") == fact.select("order_id").distinct().count()


def test_small_answers_keep_upstream_parallelism(spark, written):
    """Writing an answer as one file must not pull its window stage into one task."""
    from salesmart.session import new_run_dir
    from salesmart.sources.sinks import write_table
    q5 = written.question("q5_top_products")
    table, rows = write_table(spark, q5, new_run_dir(spark, "q5"), partitions=1)
    assert rows == q5.count() and len(table.inputFiles()) == 1
    df = q5.repartition(1)
    assert "Exchange RoundRobinPartitioning(1)" in plan(df) or "SinglePartition" in plan(df)
