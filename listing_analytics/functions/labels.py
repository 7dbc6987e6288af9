"""Rating labels: text, thermometer list, half-star number, and class targets."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def categorical(stars: Column) -> Column:
    """`1.5` as `1_5`."""
    return F.replace(stars.cast("string"), F.lit("."), F.lit("_"))


def category_stars(category: Column) -> Column:
    """`1_5` as `1.5`."""
    return F.replace(category, F.lit("_"), F.lit(".")).cast("double")


def numeric(stars: Column) -> Column:
    """Number of half stars, rounded up."""
    return F.ceil(stars * 2).cast("int")


def half_stars(stars: Column) -> Column:
    """Number of half stars, truncated."""
    return (stars * 2).cast("int")


def ordinal(stars: Column, lowest: Column, highest: Column) -> Column:
    """Thermometer list: one 1 per half star above `lowest`, zeros up to `highest` and one more."""
    length = (F.ceil((highest - lowest) * 2) + 1).cast("int")
    ones = F.ceil((stars - lowest) * 2).cast("int")
    return F.concat(F.array_repeat(F.lit(1), ones), F.array_repeat(F.lit(0), length - ones))


def class_index(category: Column, classes: Column) -> Column:
    """Zero-based position of `category` in the sorted array `classes`."""
    return (F.array_position(classes, category) - 1).cast("int")


def one_hot(category: Column, classes: Column) -> Column:
    """One 0/1 entry per class."""
    return F.transform(classes, lambda c: (c == category).cast("int"))
