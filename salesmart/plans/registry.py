"""Named queries: ``name -> (Warehouse) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from salesmart.plans.warehouse import CHART_NAMES, QUESTION_NAMES, TABLE_NAMES, Warehouse


def _table(name: str) -> Callable[[Warehouse], DataFrame]:
    return lambda w: w.table(name)


def _question(name: str) -> Callable[[Warehouse], DataFrame]:
    return lambda w: w.question(name)


def _chart(name: str) -> Callable[[Warehouse], DataFrame]:
    return lambda w: w.chart(name)


REGISTRY: dict[str, Callable[[Warehouse], DataFrame]] = {
    **{k: _table(k) for k in TABLE_NAMES},
    **{k: _question(k) for k in QUESTION_NAMES},
    **{k: _chart(k) for k in CHART_NAMES},
    "qa_profile": Warehouse.source_profile,
    "qa_duplicates": Warehouse.source_duplicates,
    "check_primary_key": Warehouse.primary_keys,
    "check_foreign_keys": Warehouse.foreign_keys,
    "row_accounting": Warehouse.row_accounting,
    "star_join": Warehouse.star_join,
    "table_row_counts": Warehouse.row_counts,
}
