"""Decoding of model outputs: top classes, half stars, hits."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def top_classes(probability: Column, k: int = 1) -> Column:
    """The `k` most probable classes in ascending order, as `{p, class_idx}`; the best is last.

    Equal probabilities are ordered by class index, so a tie goes to the higher index.
    """
    scored = F.transform(probability, lambda p, i: F.struct(p.cast("double").alias("p"), i.alias("class_idx")))
    return F.slice(F.array_sort(scored), -k, k)


def best_class(probability: Column) -> Column:
    """Index of the most probable class."""
    return F.element_at(top_classes(probability), -1)["class_idx"]


def rounded(outputs: Column) -> Column:
    """Every output rounded half to even."""
    return F.transform(outputs, lambda p: F.rint(p.cast("double")).cast("int"))


def ordinal_half_stars(outputs: Column, base: int) -> Column:
    """Half stars of a thermometer output: thresholds passed plus `base`.

    `base` is `2 * lowest star`; a base of 1 gives the half star lower reading of the same output.
    """
    return F.aggregate(rounded(outputs), F.lit(0), lambda a, x: a + x) + F.lit(base)


def hit(actual: Column, predicted: Column) -> Column:
    """1 when the prediction equals the truth (value or whole list), else 0."""
    return F.when(actual == predicted, 1).otherwise(0)
