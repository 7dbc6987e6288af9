"""Line lists: ids or categories, one per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from listing_analytics.functions import text


def clean_lines(df: DataFrame, column: str = "value", name: str = "value") -> DataFrame:
    """One column of right-stripped lines."""
    return df.select(text.rstrip(F.col(column)).alias(name))


def read_lines(spark: SparkSession, path: str, name: str = "value") -> DataFrame:
    """The right-stripped lines of text files."""
    return clean_lines(spark.read.text(path), name=name)
