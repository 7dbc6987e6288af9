"""Splitting a photo dataset for training and evaluating a model's predictions on it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from listing_analytics.functions import labels
from listing_analytics.operators import evaluation, joins, profile, sampling, splits
from listing_analytics.operators.filters import first_rows
from listing_analytics.operators.ordinals import with_ordinal
from listing_analytics.sources.tables import quoted
from listing_analytics.staging import stage

# The order on which the splits depend.
DATASET_ORDER = ("business_id", "photo_id")


def split_dataset(
    dataset: DataFrame,
    split: splits.Split,
    photo_limit: int | None = None,
    sample: float | None = None,
    order: tuple[str, ...] = DATASET_ORDER,
) -> DataFrame:
    """The dataset with `ordinal` and `split`: first rows, then the sample, then positions."""
    if photo_limit is not None:
        dataset = first_rows(dataset, photo_limit, *order)
    if sample is not None:
        dataset = sampling.sample_rows(dataset, sample, *order)
    positioned = with_ordinal(dataset, *order, total="_rows")
    if split.verification:
        splits.warn_if_empty(positioned, split.verification)
    return splits.split_rows(positioned, split, total="_rows").drop("_rows")


def split_frequencies(dataset: DataFrame, column: str = "stars") -> dict[str, DataFrame]:
    """Frequency tables of the training and validation rows, and of both."""
    used = dataset.where(F.col("split") != splits.VERIFY)
    return {"by_split": profile.frequency_table(used, column, by="split"),
            "total": profile.frequency_table(used, column)}


@dataclass(frozen=True)
class Evaluation:
    frequency: DataFrame
    range: DataFrame
    confusion: DataFrame
    accuracy: DataFrame
    report: DataFrame
    averages: DataFrame


def evaluate_predictions(
    predictions: DataFrame,
    classes: DataFrame | None = None,
    ordinal_base: int | None = None,
    normalize: str | None = None,
    truth: DataFrame | None = None,
    key: str = "photo_file",
    order: Sequence[str] | None = None,
    predicted_order: Sequence[str] | None = None,
) -> Evaluation:
    """Decode `stars, probability` rows and report on them.

    With a class map the best class is taken, else the outputs are thresholds above `ordinal_base`
    half stars. Where the `stars` are in another table, `truth`, its rows and the predictions must have the same
    keys; with the columns that order them, the same keys at the same positions. The rows are decoded once, into one row
    for each combination of stars, truth and prediction with its count, from which all reports follow.
    """
    if (order is None) != (predicted_order is None):
        raise ValueError("positions need the order of both tables")
    if truth is not None and order is not None:
        predictions = joins.align_positions(truth, predictions, key, order, predicted_order)
    elif truth is not None:
        others = [c for c in predictions.columns if c == key or c not in truth.columns]
        predictions = joins.align(truth, predictions.select(*[quoted(c) for c in others]), key)
    if (classes is None) == (ordinal_base is None):
        raise ValueError("give either a class map or the base of the ordinal outputs")
    rated = predictions.withColumn("actual", labels.half_stars(F.col("stars")))
    if classes is not None:
        decoded = evaluation.decode_categorical(rated, classes)
    else:
        decoded = evaluation.decode_ordinal(rated, ordinal_base)
    counted = stage(decoded.groupBy("stars", "actual", "predicted").agg(F.count(F.lit(1)).alias("n")), "evaluation")
    return Evaluation(
        profile.frequency_table(counted, "stars", weight="n"),
        evaluation.prediction_range(counted),
        evaluation.confusion_matrix(counted, normalize=normalize, weight="n"),
        evaluation.accuracy(counted, weight="n"),
        evaluation.classification_report(counted, weight="n"),
        evaluation.report_averages(counted, weight="n"),
    )
