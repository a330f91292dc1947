"""Exact decimal policy, decided once.

Money stays ``decimal`` from the first cast. Every rounded ratio goes
through :func:`round_ratio`, which rounds half away from zero on exact
integers, so the result never depends on a double or on an intermediate
decimal scale.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(10, 2)
_WIDE = "decimal(38,0)"


def money(col: Column) -> Column:
    """Cast to the stored money type; ANSI mode raises on overflow."""
    return col.cast(MONEY)


def cents(col: Column, scale: int = 2) -> Column:
    """An exact decimal with ``scale`` digits as an integer count of its
    smallest unit (cents for money), kept in a wide decimal."""
    return (col * F.lit(10 ** scale)).cast(_WIDE)


def _half_up_quotient(num: Column, den: Column, shift: int) -> Column:
    """round(num / den * 10**shift) for integral num, den; ties away from
    zero; null when den is 0 or null. The remainder is taken off first, so the
    decimal division is exact; overflow raises (ANSI) instead of wrapping."""
    n = num.cast(_WIDE)
    d = F.nullif(den.cast(_WIDE), F.lit(0).cast(_WIDE))
    doubled = F.abs(n) * F.lit(2 * 10 ** shift) + F.abs(d)
    twice = F.abs(d) * F.lit(2)
    q = ((doubled - doubled % twice) / twice).cast(_WIDE)
    return F.when((n < 0) != (d < 0), -q).otherwise(q)


def round_ratio(num: Column, den: Column, *, digits: int = 2, num_scale: int = 0,
                den_scale: int = 0, percent: bool = False) -> Column:
    """``round(num / den [* 100], digits)`` exactly, as ``decimal(38, digits)``.

    ``num`` and ``den`` are exact values with ``num_scale`` / ``den_scale``
    decimal digits (2 for money, 0 for counts).
    """
    shift = digits + den_scale - num_scale + (2 if percent else 0)
    n, d = cents(num, num_scale), cents(den, den_scale)
    if shift < 0:
        n, d, shift = n, d * F.lit(10 ** -shift), 0
    q = _half_up_quotient(n, d, shift)
    return (q.cast(_WIDE) / F.lit(10 ** digits).cast(_WIDE)).cast(T.DecimalType(38, digits))


def present(df: DataFrame) -> DataFrame:
    """Result shape shared with the SQL oracle: decimals become doubles and
    dates become midnight timestamps (a date has no common in-memory form
    across engines and client libraries; a timestamp does).

    Stored tables keep exact decimals and dates; this is applied only to
    answers handed to callers that compare across engines.
    """
    def shaped(f: T.StructField):
        if isinstance(f.dataType, T.DecimalType):
            return F.col(f.name).cast("double").alias(f.name)
        if isinstance(f.dataType, T.DateType):
            return F.col(f.name).cast("timestamp_ntz").alias(f.name)
        return F.col(f.name)
    return df.select(*[shaped(f) for f in df.schema.fields])
