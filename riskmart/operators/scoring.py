"""Batch scoring: one snapshot or a whole range in one pass."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.operators.modeling import TreeModel, probability
from riskmart.schemas import CUSTOMER, SNAPSHOT
from riskmart.sources import store


def score(
    model: TreeModel,
    features: DataFrame,
    model_name: str,
    start: str | date | None = None,
    end: str | date | None = None,
) -> DataFrame:
    return probability(model, store.between(features, start, end)).select(
        CUSTOMER, SNAPSHOT, F.lit(model_name).alias("model_name"), "model_predictions"
    )


def write_predictions(
    predictions: DataFrame, root: str, model_name: str, start: str | date | None = None, end: str | date | None = None
) -> None:
    """Replace the model's predictions of the snapshots from `start` to `end`."""
    inside = store.days(start, end)
    store.write_snapshots(
        predictions,
        root,
        partition_by=("model_name", SNAPSHOT),
        replace=lambda name, day: name == model_name and inside(day),
    )
