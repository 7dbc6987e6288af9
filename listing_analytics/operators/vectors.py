"""Dataset-wide vector statistics and the scaling and whitening built on them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F, types as T

from listing_analytics.functions import vectors
from listing_analytics.sources.tables import quoted

ZCA_EPSILON = 1e-6


def moments(df: DataFrame, column: str) -> DataFrame:
    """One row: `means` and population `deviations` per position, and the number of rows."""
    summary = Summarizer.metrics("mean", "variance", "count").summary(
        array_to_vector(vectors.doubles(F.col(quoted(column))))
    )
    one = df.agg(summary.alias("s")).select(
        vector_to_array("s.mean").alias("means"), vector_to_array("s.variance").alias("v"), F.col("s.count").alias("n")
    )
    # the summary divides by n - 1
    share = F.when(F.col("n") > 0, (F.col("n") - 1) / F.col("n")).otherwise(0.0)
    return one.select(
        "means",
        F.zip_with("v", F.array_repeat(share, F.size("v")), lambda v, s: F.sqrt(v * s)).alias("deviations"),
        "n",
    )


def feature_moments(df: DataFrame, column: str) -> DataFrame:
    """`position, mean, deviation` of every vector position."""
    return moments(df, column).select(
        F.posexplode(F.arrays_zip("means", "deviations")).alias("position", "m")
    ).select("position", F.col("m.means").alias("mean"), F.col("m.deviations").alias("deviation"))


def standardise_features(
    df: DataFrame, column: str, centre: bool = True, scale: bool = True, over: DataFrame | None = None
) -> DataFrame:
    """Centre and scale each position of `column` by the moments of `over`, by default of `df`.

    The moments reach the rows as one scalar value.
    """
    stats = moments(df if over is None else over, column).select(F.struct("means", "deviations").alias("m"))
    return (
        df.withColumn("_moments", stats.scalar())
        .withColumn(column, vectors.featurewise(
            F.col(quoted(column)),
            F.col("_moments")["means"] if centre else None,
            F.col("_moments")["deviations"] if scale else None,
        ))
        .drop("_moments")
    )


def standardise_samples(df: DataFrame, column: str, centre: bool = True, scale: bool = True) -> DataFrame:
    """Centre and scale each vector by its own moments."""
    return df.withColumn(column, vectors.samplewise(F.col(quoted(column)), centre, scale))


def whitening(df: DataFrame, column: str, epsilon: float = ZCA_EPSILON) -> tuple[np.ndarray, np.ndarray]:
    """The means and the symmetric d x d matrix that whitens `column` (ZCA).

    Spark computes the covariance and its principal axes; only d x d numbers come back.
    """
    one = moments(df, column).head()
    means, total = np.array(one["means"]), float(np.square(one["deviations"]).sum())
    features = df.select(array_to_vector(vectors.doubles(F.col(quoted(column)))).alias("features"))
    fitted = PCA(k=len(means), inputCol="features", outputCol="axes").fit(features)
    axes = fitted.pc.toArray()
    variances = fitted.explainedVariance.toArray() * total
    return means, (axes / np.sqrt(variances + epsilon)) @ axes.T


def whiten(df: DataFrame, column: str, epsilon: float = ZCA_EPSILON) -> DataFrame:
    """`column` centred and whitened, as doubles."""
    means, matrix = whitening(df, column, epsilon)
    schema = T.StructType([
        T.StructField(f.name, T.ArrayType(T.DoubleType())) if f.name == column else f for f in df.schema.fields
    ])

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                rows = np.stack(batch[column].to_numpy()).astype(float)
                batch[column] = list((rows - means) @ matrix)
            yield batch

    return df.mapInPandas(apply, schema)
