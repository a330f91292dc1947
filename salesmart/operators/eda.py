"""Chart-ready tables (K17-K20); the reference draws these, we return them."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.params import Params

_DEFAULT = Params()

# The tier order of the chart axis and the measures of the
# correlation matrix, as in the reference.
TIER_ORDER = ("Low", "Medium", "High")
CORRELATION_MEASURES = ("price", "freight_value", "item_total", "delivery_days")


def _thousands(col: str):
    return (F.col(col).cast("double") / F.lit(1000.0)).alias("revenue_k")


def eda_top_categories(mart_category: DataFrame, n: int = _DEFAULT.chart_top_categories_n) -> DataFrame:
    return (mart_category.orderBy(F.col("total_revenue").desc(), F.col("category_en").asc_nulls_last())
            .limit(n).select("category_en", "total_revenue", _thousands("total_revenue")))


def eda_monthly_trend(mart_monthly: DataFrame) -> DataFrame:
    return mart_monthly.select("year_month", "total_revenue", _thousands("total_revenue")).orderBy("year_month")


def eda_value_tiers(mart_customer: DataFrame) -> DataFrame:
    """People and mean lifetime spend per tier (unrounded), with the axis
    position of each tier."""
    order = F.coalesce(*[F.when(F.col("value_tier") == t, F.lit(i + 1)) for i, t in enumerate(TIER_ORDER)])
    g = mart_customer.groupBy("value_tier").agg(F.count(F.lit(1)).alias("customers"),
                                                F.sum("total_spent").alias("spent"))
    return g.select(order.alias("tier_order"), "value_tier", "customers",
                    (F.col("spent").cast("double") / F.col("customers")).alias("avg_spent"))


def eda_correlation(fact: DataFrame, measures=CORRELATION_MEASURES, digits: int = 6) -> DataFrame:
    """Pearson matrix in long form (measure_x, measure_y, r), pairwise
    complete: each pair uses the rows where both values are present.

    One global aggregate of mergeable moments (no pull of the fact to one
    machine), then ``stack`` unpivots the one-row result into the matrix.
    ``covar_pop / (stddev_pop * stddev_pop)`` with a null guard: a constant
    or single-row input gives null instead of a divide error. The diagonal
    is 1 by definition (null for a constant column).
    """
    x = {m: f"CAST(`{m}` AS DOUBLE)" for m in measures}
    aggs, cell = [], {}
    for a, b in combinations(measures, 2):
        both = f"`{a}` IS NOT NULL AND `{b}` IS NOT NULL"
        key = f"{a}__{b}"
        aggs += [f"covar_pop({x[a]}, {x[b]}) AS c_{key}",
                 f"stddev_pop(CASE WHEN {both} THEN {x[a]} END) AS sa_{key}",
                 f"stddev_pop(CASE WHEN {both} THEN {x[b]} END) AS sb_{key}"]
        cell[(a, b)] = cell[(b, a)] = f"c_{key} / nullif(sa_{key} * sb_{key}, 0D)"
    for m in measures:
        aggs.append(f"stddev_pop({x[m]}) AS s_{m}")
        cell[(m, m)] = f"CASE WHEN s_{m} > 0 THEN 1D END"
    moments = fact.agg(*[F.expr(a) for a in aggs])
    rows = ", ".join(f"'{a}', '{b}', round({cell[(a, b)]}, {digits})" for a in measures for b in measures)
    return moments.selectExpr(f"stack({len(measures) ** 2}, {rows}) AS (measure_x, measure_y, r)")
