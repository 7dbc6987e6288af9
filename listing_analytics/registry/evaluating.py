"""Evaluation of predictions and training histories."""

from pyspark.sql import functions as F

from listing_analytics.functions import labels
from listing_analytics.operators import evaluation, history, projections
from listing_analytics.plans.evaluate import evaluate_predictions
from listing_analytics.registry import base
from listing_analytics.registry.base import BUSINESS, PAIRS, query

GRID = f"""
    WITH c AS (SELECT actual, predicted, count(*) AS n FROM ({PAIRS}) AS p GROUP BY ALL),
         l AS (SELECT actual AS label FROM c UNION SELECT predicted FROM c),
         g AS (SELECT a.label AS actual, p.label AS predicted, coalesce(n, 0) AS n
               FROM l AS a CROSS JOIN l AS p LEFT JOIN c ON c.actual = a.label AND c.predicted = p.label)"""


def _shares(over: str) -> str:
    return f"""{GRID}
    SELECT actual, predicted,
           coalesce(n::DOUBLE / nullif(sum(n) OVER ({over}), 0)::DOUBLE, 0.0::DOUBLE) AS value FROM g"""


@query("confusion_matrix", f"{GRID} SELECT actual, predicted, n AS value FROM g")
def confusion_matrix(spark, sf):
    return evaluation.confusion_matrix(base.pairs(spark, sf))


@query("confusion_matrix_true", _shares("PARTITION BY actual"))
def confusion_matrix_true(spark, sf):
    return evaluation.confusion_matrix(base.pairs(spark, sf), normalize="true")


@query("confusion_matrix_pred", _shares("PARTITION BY predicted"))
def confusion_matrix_pred(spark, sf):
    return evaluation.confusion_matrix(base.pairs(spark, sf), normalize="pred")


@query("confusion_matrix_all", _shares(""))
def confusion_matrix_all(spark, sf):
    return evaluation.confusion_matrix(base.pairs(spark, sf), normalize="all")


@query("accuracy", f"SELECT avg(CAST(actual = predicted AS DOUBLE)) AS accuracy FROM ({PAIRS}) AS p")
def accuracy(spark, sf):
    return evaluation.accuracy(base.pairs(spark, sf))


REPORT = f"""
    WITH p AS ({PAIRS}),
         l AS (SELECT actual AS label FROM p UNION SELECT predicted FROM p),
         s AS (SELECT label, (SELECT count(*) FROM p WHERE actual = label) AS support,
                      (SELECT count(*) FROM p WHERE predicted = label) AS guessed,
                      (SELECT count(*) FROM p WHERE predicted = label AND actual = label) AS hits
               FROM l)
    SELECT label, coalesce(hits::DOUBLE / nullif(guessed, 0)::DOUBLE, 0.0::DOUBLE) AS "precision",
           coalesce(hits::DOUBLE / nullif(support, 0)::DOUBLE, 0.0::DOUBLE) AS recall,
           coalesce((2 * hits)::DOUBLE / nullif(guessed + support, 0)::DOUBLE, 0.0::DOUBLE) AS f1, support
    FROM s"""


@query("classification_report", REPORT)
def classification_report(spark, sf):
    return evaluation.classification_report(base.pairs(spark, sf))


@query("classification_averages", f"""
    WITH r AS ({REPORT})
    SELECT 'macro avg' AS average, round(avg("precision"), 9) AS "precision", round(avg(recall), 9) AS recall,
           round(avg(f1), 9) AS f1, CAST(sum(support) AS BIGINT) AS support FROM r
    UNION ALL
    SELECT 'weighted avg', round(sum("precision" * support) / sum(support), 9),
           round(sum(recall * support) / sum(support), 9), round(sum(f1 * support) / sum(support), 9),
           CAST(sum(support) AS BIGINT) FROM r
    UNION ALL
    SELECT 'accuracy', NULL, NULL, round(avg(CAST(actual = predicted AS DOUBLE)), 9), count(*) FROM ({PAIRS}) AS p""")
def classification_averages(spark, sf):
    averages = evaluation.report_averages(base.pairs(spark, sf))
    return averages.select(
        "average", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")], "support"
    )


@query("binary_report", REPORT.replace(PAIRS, "SELECT quality AS actual, toxic AS predicted FROM labels"))
def binary_report(spark, sf):
    return evaluation.classification_report(base.table(spark, sf, "labels"), "quality", "toxic")


@query("prediction_range", f"""
    SELECT min(actual) / 2.0::DOUBLE AS min_actual, max(actual) / 2.0::DOUBLE AS max_actual,
           min(predicted) / 2.0::DOUBLE AS min_predicted, max(predicted) / 2.0::DOUBLE AS max_predicted
    FROM ({PAIRS}) AS p""")
def prediction_range(spark, sf):
    return evaluation.prediction_range(base.pairs(spark, sf))


@query("hit_flags", """
    WITH p AS (SELECT p_partkey, p_size % 9 AS a, CAST(p_partkey % 9 AS INT) AS b FROM part),
         o AS (SELECT *, list_transform(range(9), lambda i: CASE WHEN i < a THEN 1 ELSE 0 END) AS ao,
                      list_transform(range(9), lambda i: CASE WHEN i < b THEN 1 ELSE 0 END) AS bo FROM p)
    SELECT p_partkey, CAST(a = b AS INT) AS hit, CAST(ao = bo AS INT) AS list_hit FROM o""")
def hit_flags(spark, sf):
    part = base.table(spark, sf, "part").select(
        "p_partkey", (F.lit(1.0) + F.col("p_size") % 9 / F.lit(2.0)).alias("actual"),
        (F.lit(1.0) + F.col("p_partkey") % 9 / F.lit(2.0)).alias("predicted"),
    )
    lists = part.withColumns({
        f"{c}_list": labels.ordinal(F.col(c), F.lit(1.0), F.lit(5.0)) for c in ("actual", "predicted")
    })
    hits = evaluation.add_hits(lists)
    list_hits = evaluation.add_hits(
        hits.withColumnRenamed("hit", "first"), "actual_list", "predicted_list"
    ).withColumnRenamed("hit", "list_hit")
    return list_hits.select("p_partkey", F.col("first").alias("hit"), "list_hit")


@query("success_ratio", f"""
    SELECT CAST(sum(CAST(actual = predicted AS INT)) AS BIGINT) AS correct, count(*) AS total,
           sum(CAST(actual = predicted AS INT))::DOUBLE / count(*)::DOUBLE AS ratio
    FROM ({PAIRS}) AS p""")
def success_ratio(spark, sf):
    return evaluation.success_ratio(evaluation.add_hits(base.pairs(spark, sf)))


SCORES = """
    SELECT vec_id, i - 1 AS class_idx, e[i]::DOUBLE AS p
    FROM (SELECT vec_id, embedding AS e, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)"""


@query("topk_classes", f"""
    SELECT vec_id, CAST(3 - r AS INT) AS place, CAST(class_idx AS INT) AS class_idx, round(p, 6) AS p FROM (
        SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY p DESC, class_idx DESC) AS r FROM ({SCORES}) AS s)
    WHERE r <= 3""")
def topk_classes(spark, sf):
    top = evaluation.top_classes(base.vectors(spark, sf), "embedding", 3)
    return top.select("vec_id", F.posexplode("top").alias("place", "t")).select(
        "vec_id", "place", "t.class_idx", F.round("t.p", 6).alias("p")
    )


@query("argmax_class", f"""
    SELECT vec_id, CAST(arg_max(class_idx, {{'p': p, 'i': class_idx}}) AS INT) AS class_idx
    FROM ({SCORES}) AS s GROUP BY vec_id""")
def argmax_class(spark, sf):
    return base.vectors(spark, sf).select(
        "vec_id", evaluation.predictions.best_class(F.col("embedding")).alias("class_idx")
    )


STAR_CLASSES = f"""
    SELECT CAST(row_number() OVER (ORDER BY cat) - 1 AS INT) AS class_idx, cat,
           CAST(replace(cat, '_', '.') AS DOUBLE) AS stars
    FROM (SELECT DISTINCT replace(CAST(stars AS VARCHAR), '.', '_') AS cat FROM ({BUSINESS}) AS b)"""

# Nine scores of a vector: its positions dealt round them and added up in order.
FOLDED = """
    list_transform(range(9), lambda c: list_reduce(list_transform(
        range(c, len(embedding), 9), lambda i: embedding[i + 1]::DOUBLE), lambda a, b: a + b))"""

RATED = f"""
    SELECT vec_id, 1.0::DOUBLE + (label % 9) / 2.0::DOUBLE AS stars, class_idx, p FROM (
        SELECT vec_id, class_idx, p, row_number() OVER (PARTITION BY vec_id ORDER BY p DESC, class_idx DESC) AS r
        FROM (SELECT vec_id, unnest(range(9)) AS class_idx, unnest({FOLDED}) AS p FROM embeddings) AS s)
    JOIN (SELECT vec_id AS v, label FROM embeddings) ON v = vec_id WHERE r = 1"""


def scored(spark, sf):
    """One score per star class, from all positions of the vector."""
    scores = F.transform(F.sequence(F.lit(0), F.lit(8)), lambda c: F.aggregate(
        F.filter("embedding", lambda x, i: i % 9 == c), F.lit(0.0), lambda total, x: total + x
    ))
    return base.vectors(spark, sf).select(
        "vec_id", (F.lit(1.0) + F.col("label") % 9 / F.lit(2.0)).alias("stars"),
        scores.alias("probability"),
    )


def star_classes(spark, sf):
    return projections.class_map(projections.add_labels(base.business(spark, sf)), "stars_cat")


@query("decode_categorical", f"""
    SELECT vec_id, CAST(r.class_idx AS INT) AS class_idx, cat, CAST(trunc(c.stars * 2) AS INT) AS predicted
    FROM ({RATED}) AS r JOIN ({STAR_CLASSES}) AS c ON r.class_idx = c.class_idx""")
def decode_categorical(spark, sf):
    decoded = evaluation.decode_categorical(scored(spark, sf), star_classes(spark, sf))
    return decoded.select("vec_id", "class_idx", "cat", "predicted")


@query("decode_ordinal", f"""
    SELECT vec_id, CAST(list_sum(list_transform({FOLDED},
               lambda x: CAST(round_even(x * 4 + 0.5::DOUBLE, 0) AS INT))) + 2 AS INT) AS predicted
    FROM embeddings""")
def decode_ordinal(spark, sf):
    outputs = scored(spark, sf).withColumn("probability", F.transform("probability", lambda x: x * 4 + F.lit(0.5)))
    return evaluation.decode_ordinal(outputs, base=2).select("vec_id", "predicted")


@query("evaluation_confusion", f"""
    WITH d AS (SELECT CAST(trunc(r.stars * 2) AS INT) AS actual, CAST(trunc(c.stars * 2) AS INT) AS predicted
               FROM ({RATED}) AS r JOIN ({STAR_CLASSES}) AS c ON r.class_idx = c.class_idx),
         n AS (SELECT actual, predicted, count(*) AS n FROM d GROUP BY ALL),
         l AS (SELECT actual AS label FROM d UNION SELECT predicted FROM d)
    SELECT a.label AS actual, p.label AS predicted,
           coalesce(n, 0)::DOUBLE / (SELECT count(*) FROM d)::DOUBLE AS value
    FROM l AS a CROSS JOIN l AS p LEFT JOIN n ON n.actual = a.label AND n.predicted = p.label""")
def evaluation_confusion(spark, sf):
    return evaluate_predictions(scored(spark, sf), star_classes(spark, sf), normalize="all").confusion


@query("evaluation_aligned", f"""
    WITH d AS (SELECT CAST(trunc(r.stars * 2) AS INT) AS actual, CAST(trunc(c.stars * 2) AS INT) AS predicted
               FROM ({RATED}) AS r JOIN ({STAR_CLASSES}) AS c ON r.class_idx = c.class_idx)
    SELECT avg(CAST(actual = predicted AS DOUBLE)) AS accuracy FROM d""")
def evaluation_aligned(spark, sf):
    """Truth and predictions in tables of their own, held against each other position by position."""
    both = scored(spark, sf).withColumn("photo_file", F.concat(base.text("vec_id"), F.lit(".jpg")))
    truth = both.select("photo_file", "stars", "vec_id")
    predicted = both.select("photo_file", "probability", (-F.col("vec_id")).alias("place"))
    predicted = predicted.withColumn("place", F.col("place") * -3).repartition("photo_file")
    report = evaluate_predictions(
        predicted, star_classes(spark, sf), truth=truth, order=("vec_id",), predicted_order=("place",)
    )
    return report.accuracy


def epochs(spark, sf):
    """A training history: users in the role of runs, their events of epochs."""
    return base.table(spark, sf, "events").select(
        F.col("event_type").alias("model"), F.col("user_id").alias("run_id"), F.col("event_id").alias("epoch"),
        (F.col("value") / 500).alias("accuracy"), F.col("value").alias("val_loss"),
    )


@query("last_epoch", """
    SELECT user_id AS run_id, max(event_id) AS epoch, arg_max(value / 500, event_id) AS accuracy,
           arg_max(value, event_id) AS val_loss
    FROM events GROUP BY user_id""")
def last_epoch(spark, sf):
    return history.last_epoch(epochs(spark, sf), ["run_id"], "epoch", ["accuracy", "val_loss"])


@query("best_run", """
    SELECT event_type AS model, value AS val_loss, event_id AS epoch, user_id AS run_id
    FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY value, event_id) AS r FROM events)
    WHERE r = 1""")
def best_run(spark, sf):
    return history.best_epoch(epochs(spark, sf), ["model"], "val_loss", ["run_id"], ["epoch"])
