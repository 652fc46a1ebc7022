import math

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.sql import functions as F

from ebbtide.operators import outliers, prepare, training, trees
from ebbtide.schemas import CUSTOMER, TARGET
from ebbtide.session import materialise, new_folder

NAMES = ["a", "b", "odd name"]


@pytest.fixture(scope="module")
def customers(spark):
    dice = np.random.default_rng(3)
    values = dice.normal(size=(400, 3)).round(2)
    rows = [(f"c{i}", *map(float, v), int(v[0] + v[1] * v[2] > 0.2)) for i, v in enumerate(values)]
    rows += [("null", None, 1.0, None, 1), (None, 0.5, None, 2.0, 0)]
    return materialise(spark.createDataFrame(rows, f"{CUSTOMER} string, a double, b double, `odd name` double, {TARGET} int"), "customers")


def _fitted(estimator, customers):
    kind, settings = estimator
    rows = prepare.assemble(customers, NAMES).withColumn(TARGET, F.col(TARGET).cast("double"))
    return Pipeline(stages=[kind(labelCol=TARGET, **settings)]).fit(rows)


@pytest.mark.parametrize("estimator", [
    (GBTClassifier, dict(maxIter=6, maxDepth=3, seed=1)), (RandomForestClassifier, dict(numTrees=7, maxDepth=6, seed=1)),
    (GBTClassifier, dict(maxIter=2, maxDepth=0, seed=1)), (LogisticRegression, dict(regParam=0.01))])
def test_stored_models_score_like_loaded_ones(spark, customers, rows, estimator):
    model = _fitted(estimator, customers)
    path = new_folder(spark, "model")
    training.save_model(spark, model, path, NAMES, {})
    given = customers.withColumn("not seen", F.lit(1))
    found, known = rows(trees.score_stored(spark, path, given)), rows(training.score(model, given, NAMES))
    assert [r[:3] for r in found] == [r[:3] for r in known]
    assert np.allclose([r[3:] for r in found], [r[3:] for r in known], atol=1e-12)
    assert trees.score_stored(spark, path, given.limit(0)).columns == training.score(model, given, NAMES).columns
    with pytest.raises(ValueError, match="odd name"):
        trees.score_stored(spark, path, customers.drop("odd name"))
    plan = trees.score_stored(spark, path, given)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Exchange hash" not in plan.split("BroadcastExchange")[0]


@pytest.mark.parametrize("estimator, level", [
    ((GBTClassifier, dict(maxIter=6, maxDepth=3, seed=1)), False), ((RandomForestClassifier, dict(numTrees=7, seed=1)), True)])
def test_importances_are_those_of_the_model(spark, customers, estimator, level):
    model = _fitted(estimator, customers)
    path = new_folder(spark, "model")
    training.save_model(spark, model, path, NAMES, {})
    found = {r["feature"]: r["value"] for r in trees.importances(trees.stored_nodes(spark, path), level).collect()}
    known = model.stages[0].featureImportances.toArray()
    assert np.allclose([found.get(i, 0.0) for i in range(3)], known)


def test_a_walk_by_hand(spark, rows):
    nodes = spark.createDataFrame([
        (4, 0, 1, 0.5, 2, 1, None), (4, 1, -1, None, -1, -1, 10.0), (4, 2, 0, -1.0, 3, 4, None), (4, 3, -1, None, -1, -1, 20.0),
        (4, 4, -1, None, -1, -1, 30.0), (9, 0, -1, None, -1, -1, 0.25)],
        "tree int, node int, feature int, threshold double, left_child int, right_child int, value double")
    given = spark.createDataFrame([("x", 0.0, 0.5), ("y", -1.0, 0.0), ("z", 5.0, 0.6), ("null", None, None)], "id string, p double, q double")
    found = trees.total_value(given, trees.numbers(["p", "q"]), nodes, 2, "total")
    assert rows(found, "id", "total") == [("null", 30.25), ("x", 30.25), ("y", 20.25), ("z", 10.25)]
    assert rows(trees.total_value(given, trees.numbers(["p", "q"]), nodes.limit(0), 2, "total"), "total") == [(0.0,)] * 4


def test_outlier_scores_equal_a_plain_walk(spark, customers):
    names = ["a", "b", "odd name"]
    nodes = outliers.grow_forest(customers, names, trees=9, rows_per_tree=64).toPandas()
    assert nodes["tree"].nunique() == 9 and nodes.groupby("tree")["feature"].apply(lambda f: (f < 0).sum()).max() <= 64
    scored = outliers.outlier_scores(customers, names, trees=9, rows_per_tree=64)
    assert "ArrowEvalPython" not in scored._jdf.queryExecution().toString()
    scale = 9 * float(outliers._average_path(64))
    for row in scored.collect():
        x, total = [row[n] or 0.0 for n in names], 0.0
        for _, tree in nodes.groupby("tree"):
            tree, node = tree.set_index("node"), 0
            while tree.loc[node, "feature"] >= 0:
                side = "left_child" if x[tree.loc[node, "feature"]] <= tree.loc[node, "threshold"] else "right_child"
                node = tree.loc[node, side]
            total += tree.loc[node, "value"]
        assert math.isclose(row.outlier_score, 2 ** (-total / scale), abs_tol=1e-8)


def test_trees_are_a_constant_and_no_column_of_the_rows(customers):
    """A row joined to the nodes holds a copy of all of them."""
    nodes = outliers.grow_forest(customers, NAMES, trees=9, rows_per_tree=64)
    scored = trees.total_value(customers, trees.numbers(NAMES), materialise(nodes, "nodes"), 6, "total")
    plan = scored._jdf.queryExecution().optimizedPlan()
    names = [plan.p(i).nodeName() for i in range(3) if plan.p(i) is not None]
    assert not any("Join" in name for name in names) and names.count("Project") == 1, names
