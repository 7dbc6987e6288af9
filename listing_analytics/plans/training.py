"""Training on a photo dataset with feature vectors: split, fit, predict the held-out rows, evaluate, record."""

from __future__ import annotations

import datetime
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.ml import Model, PipelineModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import DataFrame, SparkSession, functions as F

from listing_analytics.functions.text import nested_params
from listing_analytics.operators import evaluation, models, profile, projections, splits
from listing_analytics.plans.evaluate import DATASET_ORDER, Evaluation, evaluate_predictions, split_dataset
from listing_analytics.sinks import runs, tables as sinks
from listing_analytics.sources.documents import read_class_map
from listing_analytics.staging import stage

CATEGORY = "stars_cat"


@dataclass(frozen=True)
class TrainSpec:
    """The model by name and its options, the split, and the rows used.

    `features` is a list column of numbers; `params` go into the run log as they are.
    """

    model: str = "softmax"
    options: Mapping[str, object] = field(default_factory=dict)
    features: str = "features"
    split: splits.Split = splits.Split(0.05, 0.2)
    photo_limit: int | None = None
    sample: float | None = None
    order: tuple[str, ...] = DATASET_ORDER
    params: Mapping[str, object] = field(default_factory=dict)


@dataclass(frozen=True)
class Trained:
    model: Model
    classes: DataFrame
    rows: DataFrame
    predictions: DataFrame
    evaluation: Evaluation
    history: DataFrame
    run: DataFrame


def _with_label(rows: DataFrame, classes: DataFrame, features: str) -> DataFrame:
    """Feature vectors, and the class index of each row's category as `label`."""
    indexed = rows.withColumn("_list", F.col(features)).drop(features).join(
        classes.select(F.col("cat").alias(CATEGORY), "class_idx"), CATEGORY, "left"
    )
    return models.with_features(indexed, "_list", "class_idx").drop("_list", "class_idx")


def train_categorical(dataset: DataFrame, spec: TrainSpec, run_id: str, out: str = "") -> Trained:
    """Train on the categories of a dataset `business_id, photo_id, stars, stars_cat, <features>`.

    Training and validation rows must hold the same categories. The predictions are those of the
    verification rows.
    """
    rows = split_dataset(dataset, spec.split, spec.photo_limit, spec.sample, spec.order)
    profile.require_same_classes(rows, CATEGORY)
    used = rows.where(F.col("split") != splits.VERIFY)
    classes = stage(projections.class_map(used, CATEGORY), "classes")
    labelled = _with_label(rows, classes, spec.features)
    train, validation, verify = (
        labelled.where(F.col("split") == s) for s in (splits.TRAIN, splits.VALIDATION, splits.VERIFY)
    )
    fresh = models.estimator_for(train, spec.model, **spec.options).fit(train)
    losses = models.losses(fresh)
    model = models.saved(fresh)
    predictions = models.predict(model, verify)
    history, run = _records(train, validation, model, losses, spec, run_id, out)
    return Trained(
        model, classes, rows, predictions, evaluate_predictions(predictions, classes=classes), history, run
    )


def _records(
    train: DataFrame, validation: DataFrame, model: Model, losses: list[float], spec: TrainSpec, run_id: str, out: str
) -> tuple[DataFrame, DataFrame]:
    """The epochs, with the accuracies and the validation loss at the last one, and the run's row."""
    spark = train.sparkSession
    accuracy, val_accuracy = (
        evaluation.accuracy(models.predict(model, part), "label", "prediction").head()[0] for part in (train, validation)
    )
    scored = model.transform(validation)
    val_loss = None
    if "probability" in scored.columns:
        val_loss = MulticlassClassificationEvaluator(labelCol="label", metricName="logLoss").evaluate(scored)
    epochs = [(spec.model, run_id, i + 1, None, None, loss, None) for i, loss in enumerate(losses or [None])]
    epochs[-1] = (*epochs[-1][:3], accuracy, val_accuracy, epochs[-1][5], val_loss)
    history = spark.createDataFrame(
        epochs,
        "model string, run_id string, epoch int, accuracy double, val_accuracy double, loss double, val_loss double",
    )
    params = nested_params({**spec.options, **spec.params})
    started = datetime.datetime.now(datetime.timezone.utc)
    row = spark.createDataFrame(
        [(run_id, spec.model, started, len(epochs), params, out, bool(out))],
        "run_id string, model string, datetime timestamp, epochs int, params map<string,string>, "
        "results_folder string, model_saved boolean",
    )
    return history, runs.run_rows(history, row)


def write_run(trained: Trained, folder: str, run_log: str) -> None:
    """Save the model with its class map and epochs below `folder`, and append the run to `run_log`."""
    PipelineModel([trained.model]).write().overwrite().save(f"{folder}/model")
    sinks.write_class_map(trained.classes, f"{folder}/class_indices")
    runs.write_epochs(trained.history, f"{folder}/epochs", mode="overwrite")
    runs.append_runs(trained.run, run_log)


def predict_saved(
    spark: SparkSession, folder: str, dataset: DataFrame, features: str = "features", normalize: str | None = None
) -> tuple[DataFrame, Evaluation]:
    """Predictions of a saved model for `stars, <features>` rows, and their evaluation."""
    classes = read_class_map(spark, f"{folder}/class_indices")
    rows = models.with_features(dataset.withColumnRenamed(features, "_list"), "_list").drop("_list")
    predictions = models.predict(PipelineModel.load(f"{folder}/model"), rows)
    return predictions, evaluate_predictions(predictions, classes=classes, normalize=normalize)


def train_ordinal(
    dataset: DataFrame, spec: TrainSpec, base: int | None = None
) -> tuple[list[Model], DataFrame, Evaluation]:
    """Train one model per threshold of `stars_ord` and evaluate the verification rows.

    `base` is the half stars of a list without ones, by default those of the lowest star.
    """
    rows = split_dataset(dataset, spec.split, spec.photo_limit, spec.sample, spec.order)
    first = rows.agg(F.max(F.size("stars_ord")).alias("length"), F.min("stars").alias("low")).head()
    # the last entry of the list is never 1
    targets = [f"t{i}" for i in range(first["length"] - 1)]
    expanded = projections.expand_list(rows, "stars_ord", first["length"]).withColumnRenamed(spec.features, "_list")
    data = models.with_features(expanded, "_list").drop("_list")
    fitted = models.train_ordinal(data.where(F.col("split") == splits.TRAIN), targets, **spec.options)
    predictions = models.predict_ordinal(fitted, data.where(F.col("split") == splits.VERIFY))
    half_stars = int(2 * first["low"]) if base is None else base
    return fitted, predictions, evaluate_predictions(predictions, ordinal_base=half_stars)
