"""Accounts of the new months -> features -> projection -> audited predictions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.operators import cohort, project
from ebbtide.schemas import PREDICTIONS, conform


def score_accounts(
    accounts: DataFrame,
    rates: DataFrame,
    training: DataFrame,
    ratios: DataFrame,
    scored_at: str,
    model_name: str,
    model_version: str,
    model_alias: str = "champion",
    products: DataFrame | None = None,
    mapping: Mapping[str, str] | None = None,
    seed_mode: str = "after_training",
) -> DataFrame:
    """Predictions in the stored schema, ready to append. Everything is columns and windows: no Python on executors."""
    features = cohort.scoring_features(accounts, rates, training, products, mapping, seed_mode)
    audited = project.add_audit(project.score(features, ratios), scored_at, model_name, model_version, model_alias)
    return conform(audited, PREDICTIONS)


def served_version(predictions: DataFrame):
    """Version that produced the newest batch, as a scalar column."""
    return predictions.agg(F.max_by("model_version", "scored_at")).scalar()
