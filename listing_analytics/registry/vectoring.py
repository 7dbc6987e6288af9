"""Vector scaling and whitening."""

from pyspark.sql import functions as F

from listing_analytics.functions import vectors
from listing_analytics.operators import vectors as operators
from listing_analytics.registry import base
from listing_analytics.registry.base import query

VALUES = """
    SELECT vec_id, unnest(range(len(embedding))) AS position, unnest(embedding::DOUBLE[]) AS x FROM embeddings"""


@query("feature_moments", f"""
    SELECT CAST(position AS INT) AS position, round(avg(x), 6) + 0.0 AS mean, round(stddev_pop(x), 6) AS deviation
    FROM ({VALUES}) AS v GROUP BY position""")
def feature_moments(spark, sf):
    return operators.feature_moments(base.vectors(spark, sf), "embedding").select(
        "position", (F.round("mean", 6) + F.lit(0.0)).alias("mean"), F.round("deviation", 6).alias("deviation")
    )


@query("vector_rescale", f"""
    SELECT vec_id, CAST(position AS INT) AS position, round(x * (1.0::DOUBLE / 255.0), 6) + 0.0 AS value
    FROM ({VALUES}) AS v""")
def vector_rescale(spark, sf):
    scaled = base.vectors(spark, sf).withColumn("embedding", vectors.rescale(F.col("embedding"), 1.0 / 255.0))
    return base.by_position(scaled, "vec_id", "embedding")


@query("vector_samplewise", f"""
    SELECT vec_id, CAST(position AS INT) AS position,
           round((x - avg(x) OVER w) / (stddev_pop(x) OVER w + 1e-6), 6) + 0.0 AS value
    FROM ({VALUES}) AS v WINDOW w AS (PARTITION BY vec_id)""")
def vector_samplewise(spark, sf):
    scaled = operators.standardise_samples(base.vectors(spark, sf), "embedding")
    return base.by_position(scaled, "vec_id", "embedding")


@query("vector_featurewise", f"""
    SELECT vec_id, CAST(position AS INT) AS position,
           round((x - avg(x) OVER w) / (stddev_pop(x) OVER w + 1e-6), 6) + 0.0 AS value
    FROM ({VALUES}) AS v WINDOW w AS (PARTITION BY position)""")
def vector_featurewise(spark, sf):
    scaled = operators.standardise_features(base.vectors(spark, sf), "embedding")
    return base.by_position(scaled, "vec_id", "embedding")


@query("zca_whitening")
def zca_whitening(spark, sf):
    return base.by_position(operators.whiten(base.vectors(spark, sf), "embedding"), "vec_id", "embedding", 4)
