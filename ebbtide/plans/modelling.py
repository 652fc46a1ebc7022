"""Labelled rows to a trained model with everything needed to score new data."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from ..operators.demographics import OneHot
from ..operators.outliers import remove_outliers
from ..operators.prepare import (
    NOT_CORRELATED, Scaling, feature_names, fill_missing, fit_scaling, select_important, select_uncorrelated, split_ids,
)
from ..operators.sample import split_by_hash
from ..operators.training import (
    TrainedModels, load_model, save_model, score, select_best, train_candidates,
)
from ..operators.clean import drop_present
from ..session import materialise
from ..sources import read_table, write_table


@dataclass(frozen=True)
class Preparation:
    """Settings of the steps between the labelled table and the model."""

    test_size: float = 0.2
    seed: int = 42
    contamination: float = 0.05
    collinearity: float = 0.9
    collinearity_method: str = "pearson"
    importance: float = 0.0
    importance_share: float = 1.0
    importance_method: str = "GBM"
    iterations: int = 100
    depth: int = 5
    trees: int = 100


@dataclass(frozen=True)
class PreparedSets:
    """Train and test features; every choice was made on the training set."""

    train: DataFrame
    test: DataFrame
    columns: list[str]
    scaling: Scaling

    def prepare_new(self, df: DataFrame) -> DataFrame:
        """New data, nulls filled and scaled like the training set."""
        return self.scaling.transform(fill_missing(df, self.columns))


def prepare_sets(
    labelled: DataFrame, settings: Preparation = Preparation(),
    keep: Callable[[DataFrame, str], DataFrame] = materialise,
) -> PreparedSets:
    """Split, remove outliers, drop collinear and unimportant columns, scale."""
    stored = keep(labelled, "labelled")
    train, test = split_by_hash(stored, settings.test_size, settings.seed)
    train = remove_outliers(train, settings.contamination, trees=settings.trees, seed=settings.seed)
    columns = select_uncorrelated(train, settings.collinearity, settings.collinearity_method)
    columns = select_important(
        train.select(columns), settings.importance, settings.importance_share,
        settings.importance_method, seed=settings.seed, iterations=settings.iterations,
        depth=settings.depth,
    )
    train, test = (drop_present(df.select(columns), NOT_CORRELATED) for df in (train, test))
    names = feature_names(train)
    train, test = (fill_missing(df, names) for df in (train, test))
    scaling = fit_scaling(train, names)
    return PreparedSets(scaling.transform(train), scaling.transform(test), names, scaling)


def train_and_score(
    sets: PreparedSets, user_metric: str = "", choices: Mapping[str, tuple] | None = None, **options
) -> tuple[TrainedModels, PipelineModel, DataFrame, DataFrame]:
    """Candidates, the chosen model, and its predictions for both sets."""
    _, features = split_ids(sets.train)
    trained = train_candidates(features, choices=choices, **options)
    best = select_best(trained.leaderboard, user_metric).first()
    if best is None:
        known = sorted(r.metric for r in trained.leaderboard.select("metric").distinct().collect())
        raise ValueError(f"no metric {user_metric!r}; there are {', '.join(known)}")
    model = trained.models[best.model]
    return (
        trained, model, score(model, sets.train, sets.columns), score(model, sets.test, sets.columns)
    )


@dataclass(frozen=True)
class StoredRun:
    """Everything that scoring and monitoring need, as read back from one folder."""

    model: PipelineModel
    columns: list[str]
    tags: dict[str, str]
    scaling: Scaling
    encoder: OneHot
    leaderboard: DataFrame


def save_run(
    spark: SparkSession, path: str, model: PipelineModel, name: str, sets: PreparedSets, encoder: OneHot,
    leaderboard: DataFrame, tags: Mapping[str, str] | None = None,
) -> None:
    """Store the model with its columns, tags, scaling, categories, and the scores of the candidate ``name``."""
    save_model(spark, model, f"{path}/model", sets.columns, {**(tags or {}), "model": name})
    scaling = [(i, c, sets.scaling.mean[c], sets.scaling.deviation[c]) for i, c in enumerate(sets.columns)]
    tables = {
        "scaling": spark.createDataFrame(scaling, "position int, name string, mean double, deviation double"),
        "categories": spark.createDataFrame(
            [(i, c, v) for i, (c, v) in enumerate(encoder.categories)], "position int, name string, value string"),
        "leaderboard": leaderboard.filter(leaderboard["model"] == name),
    }
    for table, df in tables.items():
        write_table(df, path, table)


def load_run(spark: SparkSession, path: str) -> StoredRun:
    """A run that ``save_run`` stored, in this session or another."""
    model, columns, tags = load_model(spark, f"{path}/model")
    # one row per feature or category: as wide as the schema
    scaling = read_table(spark, f"{path}/scaling.parquet").orderBy("position").collect()
    categories = read_table(spark, f"{path}/categories.parquet").orderBy("position").collect()
    return StoredRun(
        model, columns, tags,
        Scaling({r["name"]: r["mean"] for r in scaling}, {r["name"]: r["deviation"] for r in scaling}),
        OneHot(tuple((r["name"], r["value"]) for r in categories)),
        read_table(spark, f"{path}/leaderboard.parquet"),
    )
