from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from salesmart.functions.numeric import present, round_ratio
from salesmart.functions.time import calendar_days, elapsed_days, late_flag
from tests.builders import ts


@pytest.mark.parametrize("value,expected", [
    ("0.125", "0.13"), ("1.005", "1.01"), ("2.675", "2.68"), ("-0.125", "-0.13"), ("-2.675", "-2.68"),
    ("0.124", "0.12"), ("0", "0.00")])
def test_round_ratio_ties_away_from_zero(spark, value, expected):
    df = spark.createDataFrame([(Decimal(value),)], "v decimal(10,3)")
    got = df.select(round_ratio(F.col("v"), F.lit(1), num_scale=3).alias("r")).first().r
    assert got == Decimal(expected)


def test_round_ratio_exact_where_decimal_division_would_double_round(spark):
    # 1234449999999 / 10^11 = 12.34449999999: a 6-digit intermediate would
    # round to 12.344500 and then to 12.35; exact half-up gives 12.34.
    df = spark.createDataFrame([(1234449999999, 10 ** 11)], "n long, d long")
    got = df.select(round_ratio(F.col("n"), F.col("d")).alias("r")).first().r
    assert got == Decimal("12.34")


def test_round_ratio_percent_and_null_divisor(spark):
    df = spark.createDataFrame([(Decimal("1.00"), Decimal("3.00")), (Decimal("5.00"), Decimal("0.00")),
                                (Decimal("-1.00"), Decimal("8.00"))], "n decimal(10,2), d decimal(10,2)")
    got = [r.r for r in df.select(round_ratio(F.col("n"), F.col("d"), num_scale=2, den_scale=2,
                                              percent=True).alias("r")).collect()]
    assert got == [Decimal("33.33"), None, Decimal("-12.50")]


@pytest.mark.parametrize("start,end,days", [
    ("2020-01-01 23:00", "2020-01-02 01:00", 0),      # under a day across midnight
    ("2020-05-03 09:00", "2020-05-01 10:00", -2),     # -1 day -23 h floors to -2
    ("2020-01-01 10:00", "2020-01-03 09:59", 1),
    ("2020-01-01 10:00", "2020-01-03 10:00", 2),
    ("2020-01-01 10:00", None, None),
])
def test_elapsed_days_floors(spark, start, end, days):
    df = spark.createDataFrame([(ts(start), ts(end))], "a timestamp_ntz, b timestamp_ntz")
    assert df.select(elapsed_days(F.col("a"), F.col("b")).alias("d")).first().d == days


def test_calendar_days_counts_dates(spark):
    df = spark.createDataFrame([(ts("2020-01-01 23:00"), ts("2020-01-02 01:00"))], "a timestamp_ntz, b timestamp_ntz")
    got = df.select(calendar_days(F.col("a").cast("date"), F.col("b").cast("date")).alias("d")).first().d
    assert got == 1


@pytest.mark.parametrize("delivered,promised,flag", [
    ("2020-01-10 15:00", "2020-01-10 00:00", 1),   # later on the promised day is late
    ("2020-01-10 00:00", "2020-01-10 00:00", 0),
    (None, "2020-01-10 00:00", 0),                 # missing delivery counts as on time
])
def test_late_flag(spark, delivered, promised, flag):
    df = spark.createDataFrame([(ts(delivered), ts(promised))], "a timestamp_ntz, b timestamp_ntz")
    assert df.select(late_flag(F.col("a"), F.col("b")).alias("f")).first().f == flag


def test_present_casts_decimals_and_dates(spark):
    df = spark.sql("select cast(1.5 as decimal(10,2)) m, date'2020-01-02' d, 3 i")
    types = {f.name: f.dataType.simpleString() for f in present(df).schema.fields}
    assert types == {"m": "double", "d": "timestamp_ntz", "i": "int"}


def test_decimal_out_of_range_fails(spark):
    df = spark.createDataFrame([(Decimal("123456789.12"),)], "v decimal(12,2)")
    with pytest.raises(Exception):
        df.select(F.col("v").cast("decimal(10,2)")).collect()


from decimal import Context  # noqa: E402

from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

EXACT = Context(prec=60)


@settings(max_examples=30, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.integers(-10 ** 12, 10 ** 12), st.integers(-10 ** 30, 10 ** 30)),
                          st.one_of(st.integers(-10 ** 9, 10 ** 9), st.integers(-3, 3)).filter(bool)),
                min_size=1, max_size=20),
       st.booleans())
def test_round_ratio_matches_exact_decimal(spark, pairs, percent):
    df = spark.createDataFrame([(Decimal(n).scaleb(-2, EXACT), Decimal(d)) for n, d in pairs], "n decimal(36,2), d decimal(12,0)")
    got = [r.r for r in df.select(round_ratio(F.col("n"), F.col("d"), num_scale=2,
                                              percent=percent).alias("r")).collect()]
    # Exact: half away from zero on integers.
    def rounded(n, d):
        top, bottom = abs(n) * (100 if percent else 1), abs(d)
        cents = (2 * top + bottom) // (2 * bottom)
        return Decimal(cents if (n < 0) == (d < 0) else -cents).scaleb(-2, EXACT)
    assert got == [rounded(n, d) for n, d in pairs]


def test_round_ratio_beyond_64_bits(spark):
    df = spark.createDataFrame([(Decimal(10 ** 17), Decimal(1))], "n decimal(20,0), d decimal(3,0)")
    assert df.select(round_ratio(F.col("n"), F.col("d")).alias("r")).first().r == Decimal(10 ** 17)
