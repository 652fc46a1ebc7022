import pytest
from pyspark.sql import functions as F
from pyspark.errors import PySparkException

from ebbtide.operators import clean, profile
from ebbtide.schemas import CUSTOMER


def test_duplicates_with_nulls(spark, rows):
    df = spark.createDataFrame([(1, None), (1, None), (None, "a"), (None, "a"), (2, "b")], "n int, s string")
    assert rows(clean.drop_duplicates(df)) == rows(spark.createDataFrame([(1, None), (None, "a"), (2, "b")], df.schema))
    report = clean.duplicate_report(df, "t").first()
    assert tuple(report) == ("t", 5, 3, 2, 40.0)
    assert tuple(clean.duplicate_report(df.limit(0), "t").first()) == ("t", 0, 0, 0, None)


def test_translation(spark, rows):
    mapping = spark.createDataFrame([("TINH", "PROVINCE"), ("NAM", "MALE"), ("NAM", "MALE"), (None, "x")], "VN string, EN string")
    df = spark.createDataFrame([("NAM", "NAM BO", 1), (None, "NAM", 2)], "GENDER string, TINH string, n int")
    out = clean.translate(df, mapping)
    assert out.columns == ["GENDER", "PROVINCE", "n"]
    assert rows(out) == rows(spark.createDataFrame([("MALE", "NAM BO", 1), (None, "MALE", 2)], out.schema))
    trx = df.withColumn("AMOUNT_TRANSACTION", F.lit(1))
    assert rows(clean.translate_values(trx, mapping)) == rows(trx)


def test_contradicting_translation_fails(spark):
    mapping = spark.createDataFrame([("NAM", "MALE"), ("NAM", "SOUTH")], "VN string, EN string")
    df = spark.createDataFrame([("NAM",)], "GENDER string")
    with pytest.raises(PySparkException, match="two values"):
        clean.translate_values(df, mapping).collect()


def test_sanitize(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`a b` int, `c(d)` int, `e.f` int")
    assert clean.sanitize_columns(df).columns == ["a_b", "c_d_", "e.f"]
    with pytest.raises(ValueError, match="collide"):
        clean.sanitize_columns(spark.createDataFrame([(1, 2)], "`a b` int, `A_b` int"))


def test_zero_fill_leaves_text(spark):
    df = spark.createDataFrame([(None, None, None)], "n int, d double, s string")
    assert tuple(clean.zero_fill(df).first()) == (0, 0.0, None)


def test_missing_report(spark, rows):
    df = spark.createDataFrame([(1, None, float("nan"), None), (2, "a", 1.0, None), (3, "b", None, None)],
                               "full int, s string, d double, `odd.name` int")
    assert [tuple(r) for r in profile.missing_report(df).collect()] == [
        ("d", 1, 33.33), ("odd.name", 3, 100.0), ("s", 1, 33.33)]
    assert profile.missing_report(df.limit(0)).count() == 0


def test_missing_report_is_one_pass(spark):
    df = spark.range(10).select([F.col("id").alias(f"c{i}") for i in range(50)])
    plan = profile.missing_report(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range") == 1


def test_flag_distribution(spark):
    df = spark.createDataFrame([(0,)] * 5 + [(1,)] * 2 + [(None,)], "churn_flag int")
    got = {r.churn_flag: tuple(r) for r in profile.flag_distribution(df, "churn_flag", "f").collect()}
    assert got == {0: ("f", 0, "5", "62.5 %", 5), 1: ("f", 1, "2", "25.0 %", 2)}


def test_table_profile(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), (None, 4)], f"{CUSTOMER} string, n int")
    assert tuple(profile.table_profile(df, "t").first()) == ("t", 2, "4", 4, f"{CUSTOMER}, n", "2", 2)
    assert tuple(profile.table_profile(df.drop(CUSTOMER), "t").first()) == ("t", 1, "4", 4, "n")
    assert profile.table_profile(df.limit(0), "t").first().NumofCustomers == 0


def test_distinct_counts(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "b")], "n int, s string")
    assert tuple(profile.distinct_counts(df, ["n", "s"]).first()) == (3, 1, 2)
    assert profile.distinct_values(df, ["n"]).count() == 2


def test_values_of_listed_columns_are_translated(spark, rows):
    df = spark.createDataFrame([("NAM", "NAM", "NAM")], "HASHED_CIF string, GENDER string, NOTE string")
    mapping = spark.createDataFrame([("NAM", "MALE")], "VN string, EN string")
    assert rows(clean.translate_values(df, mapping)) == [("NAM", "MALE", "MALE")]
    assert rows(clean.translate_values(df, mapping, ["NOTE"])) == [("NAM", "NAM", "MALE")]


def test_stage_report(spark, rows):
    df = spark.createDataFrame([("a", 1, 0), ("b", None, 0)], "HASHED_CIF string, churn_flag int, churn_flag_predicted int")
    report = profile.stage_report(df, "t")
    assert rows(report["flags"], "flag", "value", "actualCount") == [("churn_flag", "1", 1), ("churn_flag_predicted", "0", 2)]
    assert rows(report["missing"]) == [("churn_flag", 1, 50.0)]
    assert report["profile"].first().TotalRows == 2
    assert "flags" not in profile.stage_report(df.select("HASHED_CIF"), "t")
    assert rows(profile.stage_report(df.limit(0), "t")["flags"]) == []
