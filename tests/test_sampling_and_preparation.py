import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide.operators import joins, outliers, prepare, sample
from ebbtide.schemas import CUSTOMER, TARGET


def ids(spark, n):
    return spark.range(n).select(F.concat(F.lit("c"), "id").alias(CUSTOMER))


@pytest.mark.parametrize("n,take", [(3000, 100), (3000, 2999), (50, 80), (1, 1), (0, 5)])
def test_smallest_by_hash_is_a_sort_and_cut(spark, n, take):
    keys = [f"c{i}" for i in range(n)]
    expected = sorted(keys, key=lambda k: (hashlib.md5(f"42{k}".encode()).hexdigest(), k))[:take]
    got = sample.smallest_by_hash(ids(spark, n).repartition(3), CUSTOMER, take, 42)
    assert sorted(r[0] for r in got.collect()) == sorted(expected)


def test_sample_restricts_every_table(spark, rows):
    trx = ids(spark, 100).crossJoin(spark.range(2).withColumnRenamed("id", "k"))
    chosen = sample.sample_customers(trx, 10)
    tables = sample.restrict_to_sample({"t": trx, "p": ids(spark, 1000)}, chosen)
    assert tables["t"].count() == 20 and tables["p"].count() == 10
    assert tables["t"].columns == trx.columns


@pytest.mark.parametrize("threshold", ["-1", "10MB"])
def test_matching_a_hot_key(spark, rows, threshold):
    """A third of the rows share a key; shuffled or broadcast, the answer is the same."""
    df = spark.range(900, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 != 1, F.col("id").cast("string")).alias("k"), "id")
    keys = spark.createDataFrame([("hot",), ("4",), ("nobody",), (None,)], "k string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        inside = joins.match_keys(df, keys, "k", "left_semi")
        outside = joins.match_keys(df, keys, "k", "left_anti")
        assert inside.columns == ["k", "id"]
        assert sorted(r.id for r in inside.collect()) == sorted({*range(0, 900, 3), 4})
        assert rows(inside.unionAll(outside)) == rows(df)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_split_is_a_stable_disjoint_cover(spark, rows):
    df = ids(spark, 2000).unionAll(spark.createDataFrame([(None,)], f"{CUSTOMER} string"))
    train, test = sample.split_by_hash(df, 0.25, 1)
    again = sample.split_by_hash(df.repartition(7), 0.25, 1)
    assert rows(train) == rows(again[0]) and rows(test) == rows(again[1])
    assert rows(train.unionAll(test)) == rows(df)
    assert 0.21 < test.count() / 2001 < 0.29
    a, b = sample.split_at_random(df, 0.25, 1)
    assert a.count() + b.count() == 2001


def numbers(spark, n=400, seed=0):
    rng = np.random.default_rng(seed)
    a, b = rng.normal(size=n), rng.normal(size=n)
    target = (a + rng.normal(scale=0.5, size=n) > 0).astype(int)
    rows = [(f"c{i}", 2020, float(a[i]), float(2 * a[i]), float(b[i]), 1.0, int(target[i])) for i in range(n)]
    return spark.createDataFrame(rows, f"{CUSTOMER} string, YEAR int, a double, a2 double, b double, k double, {TARGET} int")


def test_collinear_pairs_in_order():
    names = ["p", "q", "r"]
    matrix = np.array([[1, .95, .2], [.95, 1, .99], [.2, .99, 1]])
    drop = lambda t, **o: {names[i] for i in prepare.collinear(matrix, np.array(t), 0.9, **o)}
    assert drop([.5, .1, .3]) == {"q"}          # p wins; q is gone, yet loses to r as well
    assert drop([.1, .5, .3]) == {"p", "r"}
    assert drop([.1, .1, .1]) == {"p", "q"}     # a tie drops the first
    signed = np.array([[1, -.95], [-.95, 1]])
    assert prepare.collinear(signed, np.array([.5, -.6]), 0.9) == set()
    assert prepare.collinear(signed, np.array([.5, -.6]), 0.9, use_abs=True) == {0}


def test_uncorrelated_selection(spark):
    df = numbers(spark)
    kept = prepare.select_uncorrelated(df, 0.9)
    assert kept == [CUSTOMER, "a2", "b", "k", TARGET]   # equal to the target's eye: the first goes
    assert prepare.select_uncorrelated(df, 0.9, always_keep=["a"]) == [CUSTOMER, "a", "a2", "b", "k", TARGET]
    assert prepare.select_uncorrelated(df, 0.9, method="none") == df.columns
    matrix = prepare.correlation_matrix(df, ["a", "b", "k"])
    assert np.isnan(matrix[0, 2]) and matrix[0, 1] == pytest.approx(np.corrcoef(
        *zip(*[(r.a, r.b) for r in df.collect()]))[0, 1])


def counted(spark, df, column):
    """The same rows, and how often their ``column`` was computed so far."""
    seen = spark.sparkContext.accumulator(0)

    def same(value):
        seen.add(1)
        return value

    return df.withColumn(column, F.udf(same, "double")(F.col(column).cast("double"))), seen


def test_correlations_assemble_each_row_once(spark):
    df, seen = counted(spark, numbers(spark), "a")
    prepare.correlation_matrix(df, ["a", "b"])
    assert seen.value == df.count()


def test_importances_assemble_each_row_once(spark):
    df, seen = counted(spark, numbers(spark).select(CUSTOMER, "a", "b", TARGET), "a")
    prepare.feature_importances(df, iterations=2, depth=2)
    assert seen.value == df.count()


def test_importance_selection(spark):
    df = numbers(spark).select(CUSTOMER, "a", "b", "k", TARGET)
    kept = prepare.select_important(df, 0.0, 0.5, iterations=5, depth=3)
    assert kept == [CUSTOMER, "a", TARGET]
    assert prepare.select_important(df, 0.0, 1.0, iterations=3, depth=2, always_keep=["k"])[-2:] == ["k", TARGET]
    assert prepare.select_important(df, 0.0, 0.5, method="x") == df.columns


def test_scaling(spark):
    df = numbers(spark).drop("YEAR")
    train, test = sample.split_by_hash(df, 0.3, 4)
    scaled, other = prepare.standardise(train, test)
    row = scaled.agg(F.avg("a"), F.stddev_samp("a"), F.max(F.abs("k"))).first()
    assert row[0] == pytest.approx(0, abs=1e-12) and row[1] == pytest.approx(1) and row[2] == 0
    assert other.columns == df.columns and other.count() == test.count()
    assert prepare.standardise(train, test, "none") == (train, test)
    names = ["a", "a2", "b", "k"]
    vectors = prepare.scale_vectors(prepare.fit_vector_scaling(train, names), test, names)
    one = {r[CUSTOMER]: r.scaled_features for r in vectors.collect()}
    for r in other.collect():
        assert [r[c] for c in names] == pytest.approx(one[r[CUSTOMER]])


def test_statistics_of_scaling_take_two_aggregates_however_many_columns(spark, monkeypatch):
    rows = [("a", 1.0, None, 7, 0.1), ("b", None, None, 7, 0.1), ("c", 4.0, None, 7, 0.1), ("d", 10.0, 3.0, 7, 0.1)]
    df = spark.createDataFrame(rows, f"{CUSTOMER} string, `x.1` double, lone double, k int, tenth double").repartition(3)
    plans = []
    collect, first = type(df).collect, type(df).first

    def seen(run):
        def of(self, *args):
            plans.append(self._jdf.queryExecution().optimizedPlan().toString())
            return run(self, *args)
        return of

    monkeypatch.setattr(type(df), "collect", seen(collect))
    monkeypatch.setattr(type(df), "first", seen(first))
    scaling = prepare.fit_scaling(df, ["x.1", "lone", "k", "tenth"])
    assert scaling.mean == pytest.approx({"x.1": 5.0, "lone": 3.0, "k": 7.0, "tenth": 0.1})
    assert scaling.deviation == pytest.approx({"x.1": 21 ** 0.5, "lone": 0.0, "k": 0.0, "tenth": 0.0}, abs=0)
    assert len(plans) == 1 and plans[0].count("avg(") == plans[0].count("stddev_samp(") == 1
    assert prepare.fit_scaling(df.limit(0), ["k"]) == prepare.Scaling({"k": 0.0}, {"k": 0.0})
    assert prepare.fit_scaling(df, []) == prepare.Scaling({}, {})


def test_nulls_enter_vectors_as_zero(spark):
    df = spark.createDataFrame([("x", None, 2.0)], f"{CUSTOMER} string, `a.b` double, c double")
    assert prepare.assemble(df, ["a.b", "c"]).first().features.toArray().tolist() == [0.0, 2.0]


def test_ids(spark):
    df = numbers(spark, 5)
    ids_, features = prepare.split_ids(df)
    assert ids_.columns == [CUSTOMER] and features.columns == df.columns
    assert prepare.split_ids_new_data(df, True)[0].columns == [CUSTOMER, TARGET]
    ids_, features = prepare.split_ids_new_data(df, False)
    assert ids_.columns == [CUSTOMER] and TARGET not in features.columns


def test_outliers_are_found_and_removed(spark):
    rng = np.random.default_rng(1)
    rows = [(f"c{i}", *map(float, rng.normal(size=3)), 0) for i in range(600)]
    rows += [(f"odd{i}", *map(float, rng.normal(loc=9, size=3)), 0) for i in range(6)]
    df = spark.createDataFrame(rows, f"{CUSTOMER} string, x double, y double, z double, {TARGET} int")
    scores = {r[CUSTOMER]: r.outlier_score for r in outliers.outlier_scores(df, ["x", "y", "z"], trees=30).collect()}
    assert sorted(scores, key=scores.get)[-6:] == sorted([f"odd{i}" for i in range(6)], key=scores.get)
    again = {r[CUSTOMER]: r.outlier_score for r in
             outliers.outlier_scores(df.repartition(5), ["x", "y", "z"], trees=30).collect()}
    assert again == scores
    kept = outliers.remove_outliers(df, 0.05, trees=30)
    assert kept.columns == df.columns and 570 <= kept.count() <= 580
    assert kept.filter(F.col(CUSTOMER).startswith("odd")).count() == 0


def test_every_tree_sees_its_rows(spark):
    df = ids(spark, 40_000).withColumn("x", F.rand(3)).withColumn("y", F.rand(4))
    nodes = outliers.grow_forest(df, ["x", "y"], trees=20).toPandas()
    assert nodes.tree.nunique() == 20
    assert nodes.groupby("tree").size().max() <= 2 * outliers.ROWS_PER_TREE - 1
    leaves = nodes[nodes.feature < 0]
    assert (leaves.groupby("tree").size() > 30).all()


def test_identical_rows_and_tiny_tables(spark):
    same = ids(spark, 10).select(CUSTOMER, F.lit(1.0).alias("x"), F.lit(0).alias(TARGET))
    assert outliers.remove_outliers(same, 0.1, trees=5).count() == 10
    assert outliers.remove_outliers(same.limit(1), 0.1, trees=5).count() == 1
    assert outliers.remove_outliers(same.limit(0), 0.1, trees=5).count() == 0


def test_examined_columns(spark):
    df = spark.createDataFrame([("c", 1, 2.0, 3.0, "s", 0)], f"{CUSTOMER} string, YEAR int, n double, n_l1m_mean double, s string, {TARGET} int")
    assert outliers.examined_columns(df) == ["n"]
