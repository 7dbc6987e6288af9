"""Classifier evaluation. Everything follows from the counts of (actual, predicted) pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from listing_analytics.functions import labels, predictions
from listing_analytics.sources.tables import quoted

NORMALIZE = (None, "true", "pred", "all")


def _labelled(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """The rows that have both labels; no metric counts the others."""
    return df.where(F.col(quoted(actual)).isNotNull() & F.col(quoted(predicted)).isNotNull())


def pair_counts(
    df: DataFrame, actual: str = "actual", predicted: str = "predicted", weight: str | None = None
) -> DataFrame:
    """`actual, predicted, n`: at most one row per pair of labels, whatever the size of `df`.

    `weight` names a column with the number of rows that a row stands for, here and below.

    Every pair counts at least 1. The filter on it keeps the count in each use of the result, also
    where only the labels are read, so that the uses share one shuffle and one scan of `df`.
    """
    pairs = _labelled(df, actual, predicted).groupBy(
        F.col(quoted(actual)).alias("actual"), F.col(quoted(predicted)).alias("predicted")
    )
    return pairs.agg(_rows(weight).alias("n")).where(F.col("n") > 0)


def _rows(weight: str | None) -> Column:
    return F.count(F.lit(1)) if weight is None else F.sum(quoted(weight))


def _ratio(part, whole):
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def confusion_matrix(
    df: DataFrame, actual: str = "actual", predicted: str = "predicted", normalize: str | None = None,
    weight: str | None = None,
) -> DataFrame:
    """`actual, predicted, value` for every pair of the labels seen on either side.

    `normalize` divides by the row of the true label ("true"), the column of the predicted one
    ("pred") or the total ("all"); a share of nothing is 0.
    """
    if normalize == "none":
        normalize = None
    if normalize not in NORMALIZE:
        raise ValueError(f"normalize {normalize!r} not known; expected one of {NORMALIZE}")
    counts = pair_counts(df, actual, predicted, weight)
    # the grid is the result's own shape: labels squared
    seen = counts.agg(F.array_union(F.collect_set("actual"), F.collect_set("predicted")).alias("labels"))
    grid = seen.select(F.explode("labels").alias("actual"), "labels").select(
        "actual", F.explode("labels").alias("predicted")
    )
    full = grid.join(counts, ["actual", "predicted"], "left").withColumn("n", F.coalesce("n", F.lit(0).cast("bigint")))
    if normalize is None:
        return full.select("actual", "predicted", F.col("n").alias("value"))
    over = {"true": Window.partitionBy("actual"), "pred": Window.partitionBy("predicted")}
    if normalize == "all":
        total = counts.agg(F.sum("n")).scalar()
    else:
        total = F.sum("n").over(over[normalize])
    return full.select("actual", "predicted", _ratio(F.col("n"), total).alias("value"))


def accuracy(
    df: DataFrame, actual: str = "actual", predicted: str = "predicted", weight: str | None = None
) -> DataFrame:
    """One row: share of rows whose prediction is right."""
    one = F.lit(1) if weight is None else F.col(quoted(weight))
    right = F.sum(F.when(F.col(quoted(actual)) == F.col(quoted(predicted)), one).otherwise(0))
    return _labelled(df, actual, predicted).agg(_ratio(right, F.sum(one)).alias("accuracy"))


def classification_report(
    df: DataFrame, actual: str = "actual", predicted: str = "predicted", weight: str | None = None
) -> DataFrame:
    """`label, precision, recall, f1, support` per label; 0 where a ratio is undefined."""
    zero = F.lit(0).cast("bigint")
    right = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(zero)
    sides = F.array(
        F.struct(F.col("actual").alias("label"), F.col("n").alias("support"), zero.alias("guessed"),
                 right.alias("right")),
        F.struct(F.col("predicted").alias("label"), zero.alias("support"), F.col("n").alias("guessed"),
                 zero.alias("right")),
    )
    sums = (
        pair_counts(df, actual, predicted, weight)
        .select(F.explode(sides).alias("s")).groupBy("s.label")
        .agg(*[F.sum(f"s.{c}").alias(c) for c in ("support", "guessed", "right")])
    )
    return sums.select(
        "label",
        _ratio(F.col("right"), F.col("guessed")).alias("precision"),
        _ratio(F.col("right"), F.col("support")).alias("recall"),
        _ratio(2 * F.col("right"), F.col("guessed") + F.col("support")).alias("f1"),
        "support",
    )


def report_averages(
    df: DataFrame, actual: str = "actual", predicted: str = "predicted", weight: str | None = None
) -> DataFrame:
    """`average, precision, recall, f1, support`: unweighted (macro) and support-weighted means.

    The row `accuracy` holds the share of right predictions as its `f1` and nothing else; it is the
    recall of all labels weighted by support.
    """
    scores = ("precision", "recall", "f1")
    total = F.sum("support").alias("support")

    def weighted(score: str):
        return _ratio(F.sum(F.col(score) * F.col("support")), F.sum("support"))

    none = F.lit(None).cast("double")
    rows = F.array(
        F.struct(F.lit("accuracy").alias("average"), none.alias("precision"), none.alias("recall"),
                 weighted("recall").alias("f1"), total),
        F.struct(F.lit("macro avg").alias("average"), *[F.avg(c).alias(c) for c in scores], total),
        F.struct(F.lit("weighted avg").alias("average"), *[weighted(c).alias(c) for c in scores], total),
    )
    one = classification_report(df, actual, predicted, weight).agg(rows.alias("rows"))
    return one.select(F.explode("rows").alias("r")).select("r.*")


def prediction_range(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """One row: lowest and highest star of the truth and of the predictions, from half stars."""
    return df.agg(*[
        (f(quoted(c)) / F.lit(2.0)).alias(f"{name}_{side}")
        for side, c in (("actual", actual), ("predicted", predicted))
        for name, f in (("min", F.min), ("max", F.max))
    ])


def top_classes(df: DataFrame, probability: str = "probability", k: int = 1) -> DataFrame:
    """Add `top`: the `k` most probable classes, best last."""
    if k < 1:
        raise ValueError(f"k must be positive: {k}")
    return df.withColumn("top", predictions.top_classes(F.col(quoted(probability)), k))


def decode_categorical(df: DataFrame, classes: DataFrame, probability: str = "probability") -> DataFrame:
    """Add the best class's `class_idx`, `cat`, `predicted_stars`, `best_probability` and `predicted` half stars.

    `classes` is a class map `class_idx, cat, stars`, at most one row per model output.
    """
    best = F.element_at(predictions.top_classes(F.col(quoted(probability))), -1)
    scored = df.withColumn("_best", best).withColumns({
        "class_idx": F.col("_best")["class_idx"], "best_probability": F.col("_best")["p"],
    }).drop("_best")
    named = classes.select("class_idx", "cat", F.col("stars").alias("predicted_stars"))
    return scored.join(named, "class_idx", "left").withColumn(
        "predicted", labels.half_stars(F.col("predicted_stars"))
    )


def decode_ordinal(df: DataFrame, base: int, outputs: str = "probability") -> DataFrame:
    """Add `predicted` half stars of thermometer outputs."""
    return df.withColumn("predicted", predictions.ordinal_half_stars(F.col(quoted(outputs)), base))


def add_hits(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """Add `hit`: 1 where the prediction is right."""
    return df.withColumn("hit", predictions.hit(F.col(quoted(actual)), F.col(quoted(predicted))))


def success_ratio(df: DataFrame, hit: str = "hit") -> DataFrame:
    """One row: right predictions, all predictions and their ratio."""
    right = F.coalesce(F.sum(quoted(hit)), F.lit(0)).cast("bigint")
    return df.agg(
        right.alias("correct"), F.count(F.lit(1)).alias("total"), _ratio(right, F.count(F.lit(1))).alias("ratio")
    )
