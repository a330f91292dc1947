"""Thresholds the business rules depend on, with the reference defaults."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Params:
    # Fixed values that must equal the reference's defaults.
    delivered_status: str = "delivered"
    unknown_category: str = "unknown"
    high_tier_min: int = 500
    medium_tier_min: int = 150
    growth_min_prev_revenue: int = 100_000
    growth_n: int = 3
    top_categories_n: int = 10
    top_customers_n: int = 10
    top_products_n: int = 3
    late_states_min_orders: int = 100
    late_states_n: int = 10
    chart_top_categories_n: int = 10


# Values sized for the TPC-H-shaped fixture at sf0.01 (see FIXTURES.md §2):
# with the reference defaults every customer would be High, and the growth
# and state thresholds would keep too few or all rows.
FIXTURE_PARAMS = Params(
    high_tier_min=1_300_000,
    medium_tier_min=700_000,
    growth_min_prev_revenue=10_000_000,
    late_states_min_orders=200,
)
