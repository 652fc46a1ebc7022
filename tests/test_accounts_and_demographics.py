import datetime as dt

import pytest
from pyspark.sql import functions as F

from ebbtide.operators import accounts, demographics
from ebbtide.schemas import CUSTOMER

D = dt.date
SCHEMA = ("HASHED_CIF string, HASHED_AC string, DATE_OF_STATUS date, STATUS_DESCRIPTION string, "
          "AC_CREATE date, STATUS_ID int, PRODUCT_ID int")


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def event(cif, ac, day, status="Active", created=1, status_id=1, product=7):
    return (cif, ac, D(2020, 1, day), status, D(2020, 1, created), status_id, product)


def test_status_before_creation(spark):
    missing = ("c", "a", None, "Active", D(2020, 1, 1), 1, 7)
    df = frame(spark, event("c", "a", 1), event("c", "b", 2, created=3), missing)
    assert [r.HASHED_AC for r in accounts.drop_status_before_creation(df).collect()] == ["a"]


def test_earliest_creation_and_ties(spark, rows):
    df = frame(spark, event("c", "a", 9, created=3), event("c", "a", 8, created=2), event("c", "a", 5, created=2))
    kept = accounts.keep_earliest_creation(df)
    assert kept.columns == df.columns
    assert rows(kept) == [event("c", "a", 5, created=2)]


def test_shared_accounts_take_their_holders_with_them(spark, rows):
    df = frame(
        spark, event("x", "s", 2), event("y", "s", 2), event("z", "s", 2), event("y", "own", 2),
        event("w", "free", 2), event(None, "s", 2), event(None, "loose", 2),
    )
    kept = accounts.drop_shared_accounts(df)
    assert rows(kept, "HASHED_CIF", "HASHED_AC") == rows(
        frame(spark, event("w", "free", 2), event(None, "loose", 2)), "HASHED_CIF", "HASHED_AC")


def test_one_product(spark, rows):
    df = frame(spark, event("c", "a", 2, product=9), event("c", "a", 2, product=4), event("c", "a", 3, product=9))
    assert rows(accounts.keep_one_product(df), "DATE_OF_STATUS", "PRODUCT_ID") == [
        (D(2020, 1, 2), 4), (D(2020, 1, 3), 9)]


def test_dates_and_activation(spark, rows):
    df = frame(
        spark, event("c", "both", 2), event("c", "both", 9, "Closed", status_id=2),
        event("c", "wrong", 9), event("c", "wrong", 2, "Closed", status_id=2),
        event("c", "closed only", 5, "Closed", status_id=2), event("c", "active only", 5),
        event("c", "same day", 5), event("c", "same day", 5, "Closed", status_id=2),
    )
    dates = accounts.fill_active(accounts.drop_active_after_closed(accounts.account_dates(df)))
    assert {r.HASHED_AC: (r.Active, r.Closed) for r in dates.collect()} == {
        "both": (D(2020, 1, 2), D(2020, 1, 9)), "closed only": (D(2020, 1, 2), D(2020, 1, 5)),
        "active only": (D(2020, 1, 5), None), "same day": (D(2020, 1, 5), D(2020, 1, 5))}
    held = accounts.accounts_per_customer(dates).first()
    assert (held.No_of_Acc_Held, held.num_of_Active, held.num_of_Closed) == (4, 4, 3)


def test_audit_adds_up(spark):
    df = frame(spark, event("x", "s", 2), event("y", "s", 2), event("w", "f", 2), event("w", "g", 1, created=2))
    audit = accounts.account_audit(df).orderBy("step_no").collect()
    assert [r.n_rows for r in audit] == [4, 3, 3, 1, 1, 1, 1, 1]
    assert sum(r.n_rows_dropped for r in audit) == 3 and audit[0].n_rows_dropped == 0
    empty = accounts.account_audit(df.limit(0)).collect()
    assert {r.n_rows for r in empty} == {0}


def test_keep_first_combines_before_the_shuffle(spark):
    df = spark.range(1000).select(F.lit("hot").alias("k"), F.col("id").alias("v"))
    out = accounts.keep_first(df, ["k"], ["v"])
    assert out.collect()[0].v == 0
    assert "partial_min" in out._jdf.queryExecution().executedPlan().toString()


def test_binning(spark, rows):
    mapping = spark.createDataFrame([("HANOI", "NORTH"), ("HUE", None)], "ORIGINAL string, REVISED string")
    df = spark.createDataFrame([("HANOI",), ("HUE",), ("PARIS",), (None,)], "p string")
    assert rows(demographics.bin_by_mapping(df, mapping, "g", "p")) == [
        ("HANOI", "NORTH"), ("HUE", "UNDEFINED"), ("PARIS", "UNDEFINED"), ("UNDEFINED", "UNDEFINED")]


@pytest.mark.parametrize("year,group", [
    (1945, "Others"), (1946, "boomers"), (1964, "boomers"), (1965, "genX"), (1980, "genX"),
    (1981, "millennials"), (1996, "millennials"), (1997, "genZ"), (2005, "genZ"), (2006, "Others"), (None, "Others"),
])
def test_age_group(spark, year, group):
    df = spark.createDataFrame([(year,)], "y int")
    assert df.select(demographics.age_group(F.col("y"))).first()[0] == group


def test_marital_and_country(spark, rows):
    df = spark.createDataFrame([("MARRIED", "VIETNAM"), ("DIVORCED", "LAOS"), (None, None)], "m string, c string")
    out = df.select(demographics.marital_group(F.col("m")), demographics.country_group(F.col("c")))
    assert rows(out) == [("MARRIED", "VIETNAM"), ("OTHER", "OTHER"), ("OTHER", "OTHER")]


def test_one_hot_of_unseen_values(spark):
    train = spark.createDataFrame([("x", "p q"), ("y", None)], "a string, b string")
    encoder = demographics.fit_one_hot(train, ["a", "b"])
    assert encoder.categories == (("a", "x"), ("a", "y"), ("b", "p q"))
    new = spark.createDataFrame([("z", "p q"), (None, None)], "a string, b string")
    out = encoder.transform(new)
    assert out.columns == ["a", "b", "a_x", "a_y", "b_p q"]
    assert [tuple(r)[2:] for r in out.collect()] == [(0, 0, 1), (0, 0, 0)]


def test_too_many_categories_is_an_error(spark):
    df = spark.range(6).select(F.col("id").cast("string").alias("a"), F.lit("x").alias("b"))
    assert len(demographics.fit_one_hot(df, ["a", "b"], most=6).categories) == 7
    with pytest.raises(ValueError, match="5 categories in a"):
        demographics.fit_one_hot(df, ["a", "b"], most=5)


def test_category_index_has_no_bound(spark):
    df = spark.range(3000).select(F.col("id").cast("string").alias("a"))
    assert demographics.category_index(df, ["a"]).agg(F.max("a_index")).first()[0] == 2999


def test_category_index_orders_by_frequency(spark):
    df = spark.createDataFrame([("b",), ("b",), ("a",), ("c",), (None,)], "a string")
    got = {r.a: r.a_index for r in demographics.category_index(df, ["a"]).collect()}
    assert got == {"b": 0.0, "a": 1.0, "c": 2.0, None: 3.0}
