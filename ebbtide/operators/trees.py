"""Tree ensembles as tables of nodes, walked inside Spark SQL.

A table has one row per node: tree, node (numbered from 0, the root, inside its tree), feature (a position, below 0
at a leaf), threshold, left_child, right_child, value (of a leaf). Its size is set by the model and not by the rows
that are scored, so it travels as arrays, a constant of the projection, and a fold over the depth leads each row to its leaf.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..schemas import CUSTOMER, PREDICTED, PROBABILITY_0, PROBABILITY_1, TARGET
from ..session import materialise

_PARTS = ("feature", "threshold", "left_child", "right_child", "value")


def as_arrays(nodes: DataFrame) -> DataFrame:
    """One row with ``forest``: for each tree, in order, an array of its nodes as they are walked.

    The root comes first, then the two children of each inner node side by side, so that ``left`` alone names both.
    A leaf is its own left child, and no value is above its threshold.
    """
    by_tree = nodes.groupBy("tree").agg(F.array_sort(F.collect_list(F.struct("node", *_PARTS))).alias("nodes"))
    inner = F.filter("nodes", lambda n: n["feature"] >= 0)
    children = F.flatten(F.transform(inner, lambda n: F.array(n["left_child"], n["right_child"])))
    placed = by_tree.select("tree", "nodes", F.transform(inner, lambda n: n["node"]).alias("inner"),
                            F.concat(F.array(F.lit(0)), children).alias("order"))

    def walked(number: Column, place: Column) -> Column:
        node = F.get("nodes", number)
        leaf = node["feature"] < 0
        left = F.when(leaf, place).otherwise((2 * F.array_position("inner", number) - 1).cast("int"))
        return F.struct(F.when(leaf, 0).otherwise(node["feature"]).alias("feature"),
                        F.when(leaf, F.lit(float("nan"))).otherwise(node["threshold"]).alias("threshold"),
                        left.alias("left"), node["value"].alias("value"))

    trees = placed.select("tree", F.transform("order", walked).alias("nodes"))
    ordered = F.array_sort(F.collect_list(F.struct("tree", "nodes")))
    return trees.agg(F.transform(ordered, lambda t: t["nodes"]).alias("forest"))


def leaf_value(values: Column, tree: Column, depth: int) -> Column:
    """The value of the leaf that a row's ``values``, none of them null, reach in at most ``depth`` steps.

    A value at or below the threshold goes left. A step takes one node and one value.
    """

    def step(node: Column, _) -> Column:
        right = F.when(F.get(values, node["feature"]) > node["threshold"], 1).otherwise(0)
        return F.get(tree, node["left"] + right)

    return F.aggregate(F.sequence(F.lit(1), F.lit(max(depth, 1))), F.get(tree, F.lit(0)), step, lambda node: node["value"])


def total_value(df: DataFrame, values: Column, nodes: DataFrame, depth: int, name: str) -> DataFrame:
    """Add ``name``: the sum, over all trees, of the value of the row's leaf. No trees sum to 0.

    The arrays are a scalar subquery over one stored row, and so a constant of the projection. Joined to the rows they
    would be copied, whole, into each of them.
    """
    row = df.select("*", materialise(as_arrays(nodes), "trees").scalar().alias("_forest"))

    def total(numbers: Column) -> Column:
        each = F.transform("_forest", lambda tree: leaf_value(numbers, tree, depth))
        return F.aggregate(each, F.lit(0.0), lambda a, b: a + b)

    # the values become an array once for a row, not in every step
    return row.withColumn(name, F.get(F.transform(F.array(values), total), F.lit(0))).drop("_forest")


def numbers(names: Sequence[str]) -> Column:
    """The named columns as an array of doubles, nulls as 0."""
    return F.array(*[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)) for c in names])


# --- fitted models as stored ------------------------------------------------------------------


def _stage(spark: SparkSession, path: str) -> tuple[str, dict]:
    """Folder and description of the last stage of the pipeline stored below ``path``."""
    about = json.loads(spark.read.text(f"{path}/model/metadata").first()[0])
    uids = about["paramMap"]["stageUids"]
    folder = f"{path}/model/stages/{len(uids) - 1}_{uids[-1]}"
    return folder, json.loads(spark.read.text(f"{folder}/metadata").first()[0])


def stored_nodes(spark: SparkSession, path: str) -> DataFrame:
    """The nodes of a stored forest or boosted trees, with gain and count of rows seen in training.

    ``value`` is what a leaf adds to the sum of ``total_value``: the share of the positive class over the number
    of trees for a forest, the weighted prediction for boosted trees.
    """
    folder, about = _stage(spark, path)
    data = spark.read.parquet(f"{folder}/data")
    node = F.col("nodeData")
    weights = spark.read.parquet(f"{folder}/treesMetadata").select(
        F.col("_1").alias("treeID"), F.col("_3").alias("weight"))
    seen = F.aggregate(node["impurityStats"], F.lit(0.0), lambda a, b: a + b)
    if about["class"].endswith("RandomForestClassificationModel"):
        trees = {**about["defaultParamMap"], **about["paramMap"]}["numTrees"]
        value = node["impurityStats"][1] / seen / trees
    else:
        # impurity of a regression tree: count, sum and sum of squares
        seen, value = node["impurityStats"][0], node["prediction"] * F.col("weight")
    leaf = node["leftChild"] < 0
    return data.join(F.broadcast(weights), "treeID").select(
        F.col("treeID").alias("tree"), node["id"].alias("node"),
        F.when(leaf, F.lit(-1)).otherwise(node["split"]["featureIndex"]).alias("feature"),
        F.when(~leaf, F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0))).alias("threshold"),
        node["leftChild"].alias("left_child"), node["rightChild"].alias("right_child"), value.alias("value"),
        F.when(~leaf, node["gain"]).alias("gain"), seen.alias("n"))


def importances(nodes: DataFrame, level_trees: bool) -> DataFrame:
    """(``feature``, ``value``) of the features that split some node; the values sum to 1.

    A split counts its gain times the rows it saw. With ``level_trees``, as in forests, every tree weighs the
    same; boosted trees weigh by what they gain.
    """
    splits = nodes.filter("feature >= 0").groupBy("tree", "feature").agg(F.sum(F.col("gain") * F.col("n")).alias("gain"))
    if level_trees:
        of_tree = splits.groupBy("tree").agg(F.sum("gain").alias("of_tree")).filter("of_tree > 0")
        splits = splits.join(of_tree, "tree").withColumn("gain", F.col("gain") / F.col("of_tree"))
    shares = splits.groupBy("feature").agg(F.sum("gain").alias("value"))
    whole = shares.agg(F.sum("value").alias("whole"))
    return shares.join(F.broadcast(whole), how="cross").select("feature", (F.col("value") / F.col("whole")).alias("value"))


def boosted_probability(margin: Column) -> Column:
    """Of the positive class, from the sum over boosted trees."""
    return 1 / (1 + F.exp(-2 * margin))


def score_stored(spark: SparkSession, path: str, df: DataFrame) -> DataFrame:
    """Predicted class and both probabilities by the model stored in ``path``, from its tables alone.

    The same as loading the model and transforming, without vectors. A training column that is missing is an
    error, further columns are ignored. The label is kept if the table has it.
    """
    columns = spark.read.parquet(f"{path}/about").first().train_columns.split(";")
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"columns the model was trained on are missing: {', '.join(missing)}")
    keep = [c for c in (CUSTOMER, TARGET) if c in df.columns]
    folder, about = _stage(spark, path)
    rows, values = df.select(*keep, numbers(columns).alias("_numbers")), F.col("_numbers")
    if about["class"].endswith("LogisticRegressionModel"):
        stored = spark.read.parquet(f"{folder}/data").first()
        weights = [float(w) for w in stored.coefficientMatrix.toArray()[0]]
        products = F.zip_with(values, F.array(*map(F.lit, weights)), lambda x, w: x * w)
        scored = rows.withColumn("_total", F.aggregate(products, F.lit(0.0), lambda a, b: a + b) + float(stored.interceptVector[0]))
        positive = 1 / (1 + F.exp(-F.col("_total")))
    else:
        # a tree's depth is a setting of the model
        depth = {**about["defaultParamMap"], **about["paramMap"]}["maxDepth"]
        scored = total_value(rows, values, stored_nodes(spark, path), depth, "_total")
        forest = about["class"].endswith("RandomForestClassificationModel")
        positive = F.col("_total") if forest else boosted_probability(F.col("_total"))
    scored = scored.withColumn(PROBABILITY_1, positive)
    return scored.select(
        *keep, (F.col(PROBABILITY_1) > 0.5).cast("int").alias(PREDICTED), (1 - F.col(PROBABILITY_1)).alias(PROBABILITY_0), PROBABILITY_1)
