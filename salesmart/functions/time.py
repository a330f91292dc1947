"""The two day measures, which differ on purpose."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DAY_US = 86_400_000_000


def elapsed_days(start: Column, end: Column) -> Column:
    """Whole 24-hour periods from ``start`` to ``end``, floored (−1 day −1 h
    gives −2), as int; null if either side is null. Integer arithmetic only."""
    us = F.timestamp_diff("MICROSECOND", start, end)
    floored = F.call_function("div", us - F.pmod(us, F.lit(_DAY_US)), F.lit(_DAY_US))
    return floored.cast("int")


def calendar_days(start: Column, end: Column) -> Column:
    """Calendar-day difference between two dates, as int."""
    return F.datediff(end, start)


def late_flag(delivered: Column, promised: Column) -> Column:
    """1 when delivered strictly after the promised timestamp, else 0;
    a missing delivery counts as on time (0)."""
    return F.when(delivered > promised, F.lit(1)).otherwise(F.lit(0))
