import datetime as dt

import pytest
from pyspark.sql import functions as F

from ebbtide.functions import human_format, month_index, parse_date, unit_hash


def expected_format(number):
    """Three significant digits by Python's own formatting."""
    value = float(f"{number:.3g}")
    power = 0
    while abs(value) >= 1000 and power < 4:
        value /= 1000
        power += 1
    text = f"{value:f}".rstrip("0").rstrip(".")
    return text + ["", "K", "M", "B", "T"][power]


def test_human_format(spark):
    numbers = [0, 1, 12, 999, 1000, 1225, 1234, 1235, 12345, 99950, 999499, 999500, 999950, 1e6, 2.5e9,
               7.125e12, -1234, 0.5, 0.012345, 123.456, 3.14159, 8675309]
    df = spark.createDataFrame([(float(n),) for n in numbers], "n double")
    got = {r.n: r.s for r in df.select("n", human_format(F.col("n")).alias("s")).collect()}
    assert got == {float(n): expected_format(n) for n in numbers}


def test_human_format_stays_in_the_last_unit(spark):
    row = spark.createDataFrame([(1.5e15,), (None,)], "n double").select(human_format(F.col("n")))
    assert [r[0] for r in row.collect()] == ["1500T", None]


@pytest.mark.parametrize("text,pivot,date", [
    ("05-Jan-75", None, dt.date(2075, 1, 5)), ("05-JAN-75", 2030, dt.date(1975, 1, 5)),
    ("05-Jan-19", 2030, dt.date(2019, 1, 5)), ("junk", None, None), (None, 2030, None),
])
def test_parse_date(spark, text, pivot, date):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(parse_date(F.col("t"), "dd-MMM-yy", pivot)).first()[0] == date


def test_unit_hash_is_spread_and_total(spark):
    df = spark.range(4000).select(unit_hash(F.col("id"), 7).alias("u"))
    low, high, mean = df.agg(F.min("u"), F.max("u"), F.avg("u")).first()
    assert 0 <= low < 0.01 and 0.99 < high < 1 and abs(mean - 0.5) < 0.03
    assert spark.range(1).select(unit_hash(F.lit(None).cast("string"), 7)).first()[0] is not None


def test_month_index_crosses_years(spark):
    df = spark.createDataFrame([(2001, 1, 2000, 12)], "a int, b int, c int, d int")
    at = month_index(F.col("a"), F.col("b")) - month_index(F.col("c"), F.col("d"))
    assert df.select(at).first()[0] == 1
