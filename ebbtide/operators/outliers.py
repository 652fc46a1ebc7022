"""Isolation forest (Liu, Ting and Zhou, ICDM 2008) for removing unusual training rows.

Every choice is a number taken from a hash: which rows a tree sees, the feature a node splits by, and where. So the
same table gives the same trees whatever its partitioning, and a plain query can grow them again.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window, functions as F

from ..functions import hash_bucket, row_hash
from ..schemas import CUSTOMER, TARGET
from ..session import materialise
from .trees import numbers, total_value

# Columns that are never looked at, and name parts of derived columns.
NOT_EXAMINED = [
    "HASHED_CIF", "YEAR", "MONTH", "CIF_CREATE", "L3M_CCARD_FLAG", "L3M_LOAN_FLAG", "L3M_FD_FLAG",
    "L6M_CCARD_FLAG", "L6M_LOAN_FLAG", "L6M_FD_FLAG", "churn_flag",
]
DERIVED = ["sum", "max", "min", "mean", "std"]

TREES = 100
ROWS_PER_TREE = 256
#: Draws are whole numbers below this prime.
PRIME = 2**31 - 1
#: Digits of a score that count: sums of the same numbers in another order are the same score.
DIGITS = 9

NODE_SCHEMA = (
    "tree int, node int, feature int, threshold double, left_child int, right_child int, value double"
)


def examined_columns(df: DataFrame) -> list[str]:
    """Numeric columns that take part."""
    return [
        name for name, kind in df.dtypes
        if name not in NOT_EXAMINED and name != TARGET and kind not in ("string", "date")
        and not any(part in name for part in DERIVED)
    ]


def _average_path(n: np.ndarray | float) -> np.ndarray:
    """Mean depth of an unsuccessful search in a binary tree of ``n`` rows."""
    n = np.asarray(n, dtype=float)
    below = np.maximum(n - 1, 1)
    full = 2 * (np.log(below) + np.euler_gamma) - 2 * below / np.maximum(n, 1)
    return np.where(n > 2, full, np.where(n == 2, 1.0, 0.0))


def drawn_number(*key: int) -> int:
    """32 bits that depend on the key alone."""
    return int(hashlib.md5(":".join(map(str, key)).encode()).hexdigest()[:8], 16)


def draw_factors(seed: int, tree: int) -> tuple[int, int]:
    """A tree draws rows by (factor * hash + shift) modulo ``PRIME``."""
    return 1 + drawn_number(seed, tree, 1) % (PRIME - 1), drawn_number(seed, tree, 2) % PRIME


def _grow(values: np.ndarray, tree: int, seed: int) -> pd.DataFrame:
    """One tree over a handful of rows as a table of nodes; node 0 is the root.

    A place names a node in draws: 1 is the root, 2 p and 2 p + 1 are the children of p.
    """
    limit = int(np.ceil(np.log2(max(len(values), 2))))
    nodes: list[list[float]] = []
    waiting = [(values, 0, 1, -1, 0)]  # rows, depth, place, parent, slot in the parent's row
    while waiting:
        rows, depth, place, parent, slot = waiting.pop()
        number = len(nodes)
        if parent >= 0:
            nodes[parent][slot] = number
        low, high = rows.min(axis=0), rows.max(axis=0)
        varying = np.flatnonzero(high > low)
        if depth == limit or len(varying) == 0:
            nodes.append([-1, 0.0, -1, -1, depth + float(_average_path(len(rows)))])
            continue
        feature = int(varying[drawn_number(seed, tree, place, 3) * len(varying) >> 32])
        part = drawn_number(seed, tree, place, 4) / 2.0**32
        threshold = float(low[feature] + part * (high[feature] - low[feature]))
        right = rows[:, feature] > threshold
        nodes.append([feature, threshold, -1, -1, 0.0])
        waiting.append((rows[right], depth + 1, 2 * place + 1, number, 3))
        waiting.append((rows[~right], depth + 1, 2 * place, number, 2))
    out = pd.DataFrame(nodes, columns=["feature", "threshold", "left_child", "right_child", "value"])
    out.insert(0, "node", np.arange(len(out)))
    out.insert(0, "tree", tree)
    whole = ["tree", "node", "feature", "left_child", "right_child"]
    return out.astype({c: "int32" for c in whole})


def grow_forest(
    df: DataFrame, names: Sequence[str], key: str = CUSTOMER, trees: int = TREES, seed: int = 42,
    rows: int | None = None, rows_per_tree: int = ROWS_PER_TREE,
) -> DataFrame:
    """All nodes of all trees, the trees grown in parallel.

    Each tree sees ``rows_per_tree`` rows, those of the whole table with the smallest hashes of seed, tree
    and key; every row can reach every tree, and a tree's group does not grow with the table. ``rows`` is
    the table's size if it is known.
    """
    size = df.count() if rows is None else rows
    # twice the rows a tree needs, and some, pass by chance, before anything is moved
    share = (2 * rows_per_tree + 100) / max(size, 1)
    highest = min(PRIME, int(share * PRIME) + 1)
    factors = F.array(*[F.struct(F.lit(t).alias("tree"), F.lit(a).cast("long").alias("a"), F.lit(b).cast("long").alias("b"))
                        for t, (a, b) in ((t, draw_factors(seed, t)) for t in range(trees))])
    hashed = F.pmod(hash_bucket(row_hash(F.col(key), seed), 12), F.lit(PRIME))
    keyed = df.select(F.col(key), numbers(names).alias("values"), hashed.alias("hash"))
    drawn = F.transform(factors, lambda f: F.struct(f["tree"].alias("tree"), F.pmod(f["a"] * F.col("hash") + f["b"], F.lit(PRIME)).alias("draw")))
    reached = keyed.withColumn("reached", F.filter(drawn, lambda d: d["draw"] <= highest))
    drawn = reached.select(key, "values", F.inline("reached"))
    order = Window.partitionBy("tree").orderBy("draw", key)
    sample = drawn.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= rows_per_tree)

    def grow(group: pd.DataFrame) -> pd.DataFrame:
        ordered = group.sort_values("place")
        return _grow(np.stack(ordered["values"].to_numpy()), int(ordered["tree"].iloc[0]), seed)

    return sample.select("tree", "place", "values").groupBy("tree").applyInPandas(grow, NODE_SCHEMA)


def outlier_scores(
    df: DataFrame, names: Sequence[str], key: str = CUSTOMER, trees: int = TREES, seed: int = 42,
    rows_per_tree: int = ROWS_PER_TREE,
) -> DataFrame:
    """Add ``outlier_score`` between 0 and 1, high for rows that few cuts set apart."""
    rows = df.count()
    # fewer than two nodes per row of a tree, whatever the size of the table
    nodes = materialise(grow_forest(df, names, key, trees, seed, rows, rows_per_tree), "forest")
    seen = min(rows_per_tree, rows)
    scale = max(float(_average_path(seen)), 1.0) * trees
    depth = int(np.ceil(np.log2(max(seen, 2))))
    scored = total_value(df, numbers(names), nodes, depth, "outlier_score")
    return scored.withColumn("outlier_score", F.round(F.pow(F.lit(2.0), -F.col("outlier_score") / scale), DIGITS))


def remove_outliers(
    train: DataFrame, contamination: float, key: str = CUSTOMER, trees: int = TREES, seed: int = 42
) -> DataFrame:
    """Drop about ``contamination`` of the rows, those with the highest scores.

    Decision: the outliers are removed and the rest is returned, as the step's purpose says.
    """
    names = examined_columns(train)
    # written, so that the threshold and the filter do not each run the scoring
    scored = materialise(outlier_scores(train, names, key, trees, seed), "outlier_scores")
    cut = scored.agg(F.percentile_approx("outlier_score", 1.0 - contamination, 10000)).first()[0]
    if cut is None:
        return train
    return scored.filter(F.col("outlier_score") <= cut).drop("outlier_score")


# workers get these functions by value and need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
