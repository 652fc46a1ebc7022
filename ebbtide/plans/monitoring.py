"""Scoring a later month and comparing it with what was seen in training."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.clean import drop_present
from ..operators.evaluate import classification_metrics, monitoring_table
from ..operators.prepare import fill_missing
from ..operators.training import score
from ..schemas import TARGET
from .modelling import load_run


def score_new_data(run: str, features: DataFrame, monitoring: bool) -> DataFrame:
    """Predictions of the run stored in the folder ``run`` for new customers, with the label when monitoring.

    The columns are aligned with the stored ones, and scaled with the training set's statistics.
    """
    stored = load_run(features.sparkSession, run)
    known = features if monitoring else drop_present(features, [TARGET])
    scaled = stored.scaling.transform(fill_missing(known, stored.columns))
    return score(stored.model, scaled, stored.columns)


def monitor(scored: DataFrame, run: str) -> DataFrame:
    """Metrics on the new month beside the metrics stored with the model in the folder ``run``."""
    original = load_run(scored.sparkSession, run).leaderboard.select(
        F.col("metric").alias("metrics"), F.col("value").alias("original_model_score")
    )
    return monitoring_table(classification_metrics(scored), original)
