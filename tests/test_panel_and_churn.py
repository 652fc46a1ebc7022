import datetime as dt
import random
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F

from ebbtide.operators import churn, grouped, panel, trailing
from ebbtide.schemas import CUSTOMER, PANEL_MEASURES, RAW_TRANSACTION

D = dt.date


def week(cif, year, month, n=1, account="a", ccy="VND", balance="5.00", week_no=1):
    money = Decimal("1.25")
    return (year, month, week_no, cif, account, n, *[1] * 10, ccy,
            None if balance is None else Decimal(balance), money, money, money, money)


def raw(spark, *rows):
    return spark.createDataFrame(list(rows), RAW_TRANSACTION)


def customers(spark, **created):
    return spark.createDataFrame(list(created.items()), f"{CUSTOMER} string, CIF_CREATE date")


def months(df, *columns):
    return [tuple(r) for r in df.orderBy(CUSTOMER, "date").select(*columns).collect()]


def test_currency_modes(spark, rows):
    df = raw(spark, week("x", 2020, 1), week("x", 2020, 1, ccy="USD"), week("y", 2020, 1))
    assert panel.keep_currency(df, "VND").count() == 2
    assert rows(panel.keep_currency(df, "VND", "customers"), CUSTOMER) == [("y",)]
    assert panel.other_currency_report(df, "VND").first()[0] == 1
    with pytest.raises(ValueError):
        panel.keep_currency(df, "VND", "other")


def test_rollup_of_a_hot_customer(spark):
    """A customer with a third of all rows gives the sums that adding up by hand gives."""
    random.seed(3)
    data = [week("hot", 2020, random.randint(1, 3), random.randint(0, 9), f"a{random.randint(1, 40)}", week_no=w % 5 + 1)
            for w in range(400)]
    data += [week(f"c{i % 80}", 2020, random.randint(1, 3), random.randint(0, 9)) for i in range(800)]
    frame = pd.DataFrame(data, columns=RAW_TRANSACTION.names)
    by_hand = frame.groupby(["HASHED_CIF", "MONTH"]).agg(n=("NO_TRANSATION", "sum"), a=("HASHED_AC", "nunique"))
    got = {(r.HASHED_CIF, r.MONTH): (r.NO_TRANSATION, r.No_of_Accounts)
           for r in panel.rollup_monthly(raw(spark, *data).repartition(7)).collect()}
    assert got == {key: (int(r.n), int(r.a)) for key, r in by_hand.iterrows()}


def test_rollup_combines_before_every_shuffle(spark):
    plan = panel.rollup_monthly(raw(spark, week("x", 2020, 1)))._jdf.queryExecution().executedPlan().toString()
    below = plan.split("Exchange")
    assert len(below) == 3 and all("partial_sum" in part or "merge_sum" in part for part in below[1:])


def filled(spark, rows, created=None, **options):
    monthly = panel.add_month_date(panel.rollup_monthly(raw(spark, *rows)))
    flagged = panel.add_new_customer_flag(monthly, customers(spark, **(created or {"nobody": None})))
    return panel.fill_month_gaps(flagged, **options)


def test_gaps_over_the_new_year(spark):
    df = filled(spark, [week("x", 2019, 11), week("x", 2020, 2), week("y", 2019, 12)])
    assert months(df, CUSTOMER, "YEAR", "MONTH", "date", "NO_TRANSATION", "cif_missing_flag") == [
        ("x", 2019, 11, D(2019, 11, 1), 1, 0), ("x", 2019, 12, D(2019, 12, 1), None, 1),
        ("x", 2020, 1, D(2020, 1, 1), None, 1), ("x", 2020, 2, D(2020, 2, 1), 1, 0),
        ("y", 2019, 11, D(2019, 11, 1), None, 1), ("y", 2019, 12, D(2019, 12, 1), 1, 0),
        ("y", 2020, 1, D(2020, 1, 1), None, 1), ("y", 2020, 2, D(2020, 2, 1), None, 1)]


def test_gap_filling_needs_one_shuffle_by_customer(spark):
    stored = spark.createDataFrame(
        [("x", 2020, 1, D(2020, 1, 1), 3)], f"{CUSTOMER} string, YEAR int, MONTH int, date date, NO_TRANSATION long")
    bounds = F.lit(D(2019, 12, 1)), F.lit(D(2020, 3, 1))
    labels = churn.churn_label(panel.fill_month_gaps(stored, bounds, attributes=()))
    plan = labels._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan
    assert labels.count() == 4


def test_given_bounds_never_cut_real_rows(spark):
    bounds = F.lit(D(2020, 2, 1)), F.lit(D(2020, 3, 1))
    df = filled(spark, [week("x", 2020, 1), week("x", 2020, 5)], bounds=bounds)
    assert [r[0].month for r in months(df, "date")] == [1, 2, 3, 4, 5]


def test_rows_without_a_month_and_without_a_customer_stay(spark):
    df = filled(spark, [week("x", 2020, 1), week("x", 2020, 3), week("x", None, None), week(None, 2020, 2)])
    assert df.filter(F.col("date").isNull()).count() == 1
    assert df.filter(F.col(CUSTOMER).isNull()).count() == 3
    assert df.filter((F.col(CUSTOMER) == "x") & F.col("date").isNotNull()).count() == 3
    alone = filled(spark, [week("x", 2020, 1), week("y", None, None)])
    assert alone.filter(F.col(CUSTOMER) == "y").count() == 1


def test_balance_is_carried_both_ways_of_writing_it(spark):
    data = [week("x", 2020, 2, balance="7.00"), week("x", 2020, 4, balance=None), week("y", 2020, 1), week("y", 2020, 6)]
    expected = [("x", None), ("x", Decimal("7.00")), ("x", Decimal("7.00")), ("x", Decimal("7.00")),
                ("x", Decimal("7.00")), ("x", Decimal("7.00"))] + [("y", Decimal("5.00"))] * 6
    later = panel.carry_balance_forward(filled(spark, data))
    at_once = filled(spark, data, carry=["PRE_CLS_BAL"])
    assert months(later, CUSTOMER, "PRE_CLS_BAL") == months(at_once, CUSTOMER, "PRE_CLS_BAL") == expected


def test_nothing_is_added_before_creation(spark):
    data = [week("early", 2020, 1), week("early", 2020, 5), week("late", 2020, 2), week("late", 2020, 4),
            week("new", 2020, 3), week("old", 2020, 3)]
    created = {"early": D(2020, 1, 9), "late": D(2020, 3, 20), "new": D(2020, 3, 31), "old": None}
    kept = panel.drop_months_before_creation(filled(spark, data, created))
    by_customer = {}
    for cif, date, flag in months(kept, CUSTOMER, "date", "new_customer_flag"):
        by_customer.setdefault(cif, []).append((date.month, flag))
    assert [m for m, _ in by_customer["early"]] == [1, 2, 3, 4, 5]
    # the real row of February stays although the customer is said to be created in March
    assert [m for m, _ in by_customer["late"]] == [2, 3, 4, 5]
    assert by_customer["new"] == [(3, 1), (4, None), (5, None)]
    assert [m for m, _ in by_customer["old"]] == [1, 2, 3, 4, 5]


def test_customer_listed_twice_keeps_one_row_per_month(spark):
    monthly = panel.add_month_date(panel.rollup_monthly(raw(spark, week("x", 2020, 3))))
    twice = spark.createDataFrame([("x", D(2020, 3, 5)), ("x", D(2021, 1, 1)), ("x", None)], f"{CUSTOMER} string, CIF_CREATE date")
    row = panel.add_new_customer_flag(monthly, twice).collect()
    assert [(r.CIF_CREATE, r.new_customer_flag) for r in row] == [(D(2020, 3, 5), 1)]


def test_whole_panel_is_regular(spark):
    random.seed(5)
    data = [week(f"c{random.randint(1, 30)}", y, m) for y in (2019, 2020) for m in range(1, 13) for _ in range(4)]
    df = panel.monthly_panel(raw(spark, *data), customers(spark, c1=D(2019, 6, 1), c2=None))
    per = df.groupBy(CUSTOMER).agg(
        F.count("*").alias("n"), F.count_distinct("YEAR", "MONTH").alias("d"), F.min("date").alias("a"),
        F.max("date").alias("z")).collect()
    for r in per:
        if r.HASHED_CIF == "c1":  # its real rows may lie before its creation
            continue
        assert r.n == r.d == (r.z.year - r.a.year) * 12 + r.z.month - r.a.month + 1
        assert r.z == D(2020, 12, 1) and r.a == D(2019, 1, 1)
    added = df.filter("HASHED_CIF = 'c1' AND cif_missing_flag = 1").agg(F.min("date")).first()[0]
    assert added is None or added >= D(2019, 6, 1)
    assert df.filter(" OR ".join(f"{c} IS NULL" for c in df.columns)).count() == 0
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, panel.monthly_panel(
        raw(spark, *data).repartition(5), customers(spark, c1=D(2019, 6, 1), c2=None)).collect()))


def series(spark, counts, cif="x"):
    rows = [(cif, 2020 + i // 12, i % 12 + 1, n) for i, n in enumerate(counts)]
    return spark.createDataFrame(rows, f"{CUSTOMER} string, YEAR int, MONTH int, NO_TRANSATION long")


def test_label_looks_ahead(spark):
    df = churn.churn_label(series(spark, [4, 0, 0, 3, 0, 0, 0]))
    got = [tuple(r)[3:] for r in df.orderBy("YEAR", "MONTH").collect()]
    assert got == [(0, 0, 0, 1), (0, 3, 3, 0), (3, 0, 3, 0), (0, 0, 0, 1), (0, 0, 0, 1),
                   (0, None, None, 0), (None, None, None, 0)]
    complete = churn.churn_label(series(spark, [4, 0, 0]), incomplete="null").orderBy("MONTH").collect()
    assert [r.churn_flag for r in complete] == [1, None, None]
    assert churn.churn_label(series(spark, [4])).first().churn_flag == 0
    with pytest.raises(ValueError):
        churn.churn_label(df, "other")


def test_label_ignores_the_past(spark):
    a = churn.churn_label(series(spark, [9, 9, 1, 0, 0])).filter("MONTH >= 3").orderBy("MONTH").collect()
    b = churn.churn_label(series(spark, [0, 0, 1, 0, 0])).filter("MONTH >= 3").orderBy("MONTH").collect()
    assert a == b


def test_per_group_function(spark):
    def total(pdf):
        return pd.DataFrame({CUSTOMER: [pdf[CUSTOMER].iloc[0]], "n": [pdf.NO_TRANSATION.sum()]})

    df = series(spark, [1, 2, 3]).unionAll(series(spark, [5], "y"))
    schema = f"{CUSTOMER} string, n long"
    got = grouped.apply_per_group(df, [CUSTOMER], total, schema)
    assert sorted(map(tuple, got.collect())) == [("x", 6), ("y", 5)]
    assert grouped.apply_per_group(df.limit(0), [CUSTOMER], total, schema).count() == 0


def test_a_customer_listed_twice_stays_one_row(spark):
    listed = spark.createDataFrame(
        [("x", "2001-02-01", "b", 1.0), ("x", "2001-01-01", "c", 2.0), ("x", "2001-01-01", "a", 3.0), ("y", None, "d", 4.0)],
        f"{CUSTOMER} string, CIF_CREATE string, GENDER string, AVG_INCOME double")
    joined = churn.with_demographics(series(spark, [1]).unionAll(series(spark, [2], "y")), listed)
    assert sorted((r[CUSTOMER], r.GENDER) for r in joined.collect()) == [("x", "c"), ("y", "d")]


def measured(spark):
    random.seed(11)
    rows = []
    for c in range(12):
        for i in range(8):  # 2019-11 .. 2020-06
            if c and random.random() < 0.3:
                continue
            year, month = (2019, 11 + i) if i < 2 else (2020, i - 1)
            rows.append((f"c{c}", year, month, random.randint(0, 50), None if random.random() < 0.1 else round(random.uniform(-9, 9), 2)))
    return rows, spark.createDataFrame(rows, f"{CUSTOMER} string, YEAR int, MONTH int, n long, v double")


def close(a, b):
    if a is None or b is None or pd.isna(b):
        return a is None and (b is None or pd.isna(b))
    return a == pytest.approx(b, abs=1e-9)


def test_trailing_long_and_wide_by_hand(spark):
    rows, df = measured(spark)
    frame = pd.DataFrame(rows, columns=["c", "y", "m", "n", "v"])
    frame["age"] = 2020 * 12 + 4 - (frame.y * 12 + frame.m)
    long = {(r[CUSTOMER], r.months): r for r in trailing.trailing_long(df, 2020, 4, 5, ["n", "v"]).collect()}
    wide = {r[CUSTOMER]: r for r in trailing.trailing_features(df, 2020, 4, 5, ["n", "v"]).collect()}
    assert len(next(iter(wide.values()))) == 1 + 2 * 5 * 5
    expected = set()
    for i in range(1, 6):
        inside = frame[(frame.age >= 0) & (frame.age < i)]
        for c, group in inside.groupby("c"):
            expected.add((c, i))
            for name in ("n", "v"):
                x = group[name].dropna()
                by_hand = {"sum": x.sum() if len(x) else None, "max": x.max(), "min": x.min(), "mean": x.mean(), "std": x.std()}
                for suffix, value in by_hand.items():
                    assert close(long[c, i][f"{name}_{suffix}"], value)
                    assert close(wide[c][f"{name}_l{i}m_{suffix}"], value)
    assert set(long) == expected
    for c, row in wide.items():
        for i in range(1, 6):
            if (c, i) not in expected:
                assert row[f"n_l{i}m_sum"] is None and row[f"v_l{i}m_std"] is None


def test_wide_form_moves_rows_once(spark):
    _, df = measured(spark)
    plan = trailing.trailing_features(df, 2020, 4, 5, ["n"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_trailing_names():
    names = [f"{c}_l{i}m_{a}" for i in range(1, 7) for c in trailing.TRAILING_COLUMNS for a in trailing.AGGREGATES]
    assert len(set(names)) == 510 and set(trailing.TRAILING_COLUMNS) == set(PANEL_MEASURES)


def test_merges(spark, rows):
    months_ = spark.createDataFrame([("x", 2020, 5, 1), ("y", 2020, 5, 2), ("x", 2020, 4, 3), ("z", 2020, 5, 4)],
                                    f"{CUSTOMER} string, YEAR int, MONTH int, n int")
    held = spark.createDataFrame([("x", 2), ("y", None)], f"{CUSTOMER} string, No_of_Acc_Held long")
    people = spark.createDataFrame([("q", "M", Decimal(1))], f"{CUSTOMER} string, GENDER string, AVG_INCOME decimal(18,2)")
    people = people.withColumn("GENDER_A B", F.lit(1))
    out = churn.merge_tables(months_, held, people, 2020, 5)
    assert out.columns == [CUSTOMER, "YEAR", "MONTH", "n", "No_of_Acc_Held", "GENDER_A_B"]
    assert rows(out) == [("x", 2020, 5, 1, 2, None)]
    labels = churn.churn_label(series(spark, [1] * 7)).filter("MONTH = 4")
    assert churn.with_churn_label(out, labels, 2020, 5).first().churn_flag is None


def test_groups_are_dealt_to_several_tasks(spark):
    df = spark.range(64).select(F.col("id").cast("string").alias(CUSTOMER))
    got = grouped.apply_per_group(df, [CUSTOMER], lambda pdf: pdf, f"{CUSTOMER} string")
    assert got.select(F.spark_partition_id()).distinct().count() > 1 and got.count() == 64
