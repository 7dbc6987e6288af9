"""Models on the given vectors."""

from pyspark.sql import Window, functions as F

from listing_analytics.operators import evaluation, kernel, models, projections
from listing_analytics.operators.splits import Split
from listing_analytics.plans.training import TrainSpec, train_categorical
from listing_analytics.registry import base
from listing_analytics.registry.base import query


def rows(spark, sf):
    return models.with_features(base.vectors(spark, sf), "embedding", "label")


def pairs(predicted):
    return evaluation.pair_counts(
        predicted.withColumn("prediction", F.col("prediction").cast("int")), "label", "prediction"
    )


@query("train_classifier")
def train_classifier(spark, sf):
    data = rows(spark, sf)
    return pairs(models.predict(models.train_model(data, "dense"), data))


@query("batch_predict")
def batch_predict(spark, sf):
    data = rows(spark, sf)
    out = models.predict(models.train_model(data, "softmax"), data)
    return out.select("vec_id", F.col("prediction").cast("int").alias("prediction"), F.size("probability").alias("classes"))


@query("train_ordinal")
def train_ordinal(spark, sf):
    rated = base.vectors(spark, sf).withColumn("stars", F.lit(1.0) + F.col("label") % 9 / F.lit(2.0))
    labelled = models.with_features(projections.add_labels(rated), "embedding")
    length = labelled.agg(F.max(F.size("stars_ord"))).head()[0]
    data = projections.expand_list(labelled, "stars_ord", length=length)
    # the last threshold is never passed: the list is one longer than the range
    fitted = models.train_ordinal(data, [f"t{i}" for i in range(length - 1)])
    decoded = evaluation.decode_ordinal(models.predict_ordinal(fitted, data), base=2)
    return decoded.select("vec_id", F.col("stars_num").alias("actual"), "predicted")


@query("rff_svm")
def rff_svm(spark, sf):
    """A kernel machine of the default size on all vectors."""
    data = base.vectors(spark, sf)
    return pairs(kernel.fit_kernel_machine(data, "embedding", "label").predict(data, "embedding"))


@query("random_search")
def random_search(spark, sf):
    data = rows(spark, sf)
    space = {"regParam": [0.0, 0.01, 0.1, 1.0], "maxIter": [5, 10]}
    trials = models.random_search(data, models.softmax_head(data), space, max_trials=8)
    return spark.createDataFrame(
        [(t.trial, t.params["regParam"], t.params["maxIter"], t.score) for t in trials],
        "trial int, regParam string, maxIter string, score double",
    )


@query("random_search_halving", """
    SELECT 9 AS trials, 9 AS settings, true AS in_range, true AS in_order, 3 AS rounds, 1 AS finalists FROM (SELECT count(*) FROM embeddings)""")
def random_search_halving(spark, sf):
    """Nine settings of a space of a thousand million: those that stay behind are not fitted further."""
    data = rows(spark, sf)
    space = {
        "regParam": [10.0 ** (-i / 100) for i in range(1000)], "elasticNetParam": [i / 1000 for i in range(1000)],
        "tol": [10.0 ** (-3 - i / 200) for i in range(1000)],
    }
    trials = models.random_search(
        data, models.softmax_head(data), space, max_trials=9, halving=models.Halving("maxIter", 2, 18), parallelism=4
    )
    found = spark.createDataFrame([(i, str(t.params), t.rounds, t.score) for i, t in enumerate(trials)], "place int, params string, rounds int, score double")
    before = F.lag(F.struct("rounds", "score")).over(Window.orderBy("place"))
    found = found.withColumn("ordered", F.coalesce(before >= F.struct("rounds", "score"), F.lit(True)))
    return found.agg(
        F.count("*").cast("int").alias("trials"), F.countDistinct("params").cast("int").alias("settings"),
        F.bool_and(F.col("score").between(0, 1)).alias("in_range"), F.bool_and("ordered").alias("in_order"),
        F.max("rounds").alias("rounds"), F.sum((F.col("rounds") == 3).cast("int")).cast("int").alias("finalists"),
    )


@query("train_evaluate")
def train_evaluate(spark, sf):
    rated = projections.add_labels(base.vectors(spark, sf).select(
        base.text("label").alias("business_id"), base.text("vec_id").alias("photo_id"),
        (F.lit(1.0) + F.col("label") % 9 / F.lit(2.0)).alias("stars"), F.col("embedding").alias("features"),
    ))
    # in the order of the photo ids every part holds every category
    spec = TrainSpec("softmax", {}, split=Split(0.1, 0.2), order=("photo_id",))
    return train_categorical(rated, spec, "run").evaluation.confusion
