"""Profiles, metrics, decoding, histories."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from listing_analytics.operators import evaluation, history, profile
from listing_analytics.plans.evaluate import evaluate_predictions, split_dataset, split_frequencies
from listing_analytics.operators.splits import Split

PAIRS = [(2, 2)] * 5 + [(2, 3)] * 2 + [(3, 3)] * 4 + [(3, 5)] + [(4, 2)] * 3


@pytest.fixture(scope="module")
def pairs(spark):
    return spark.createDataFrame(PAIRS, "actual int, predicted int")


def test_confusion_matrix_covers_labels_of_both_sides(pairs):
    got = {(r.actual, r.predicted): r.value for r in evaluation.confusion_matrix(pairs).collect()}
    labels = {2, 3, 4, 5}
    assert got == {(a, p): Counter(PAIRS)[(a, p)] for a in labels for p in labels}
    assert sum(got.values()) == len(PAIRS)


@pytest.mark.parametrize("mode,side", [("true", 0), ("pred", 1)])
def test_normalised_lines_sum_to_one_or_zero(pairs, mode, side):
    sums = Counter()
    for r in evaluation.confusion_matrix(pairs, normalize=mode).collect():
        sums[r[side]] += r.value
    empty = {0: 5, 1: 4}[side]  # never true / never predicted
    assert all(math.isclose(s, 0 if label == empty else 1) for label, s in sums.items())


def test_normalize_names(pairs):
    assert evaluation.confusion_matrix(pairs, normalize="none").agg(F.sum("value")).head()[0] == len(PAIRS)
    with pytest.raises(ValueError):
        evaluation.confusion_matrix(pairs, normalize="rows")


def test_report_by_hand(pairs):
    rows = {r.label: r for r in evaluation.classification_report(pairs).collect()}
    assert rows[2].precision == 5 / 8 and rows[2].recall == 5 / 7 and rows[2].support == 7
    assert (rows[4].precision, rows[4].recall, rows[4].f1) == (0.0, 0.0, 0.0)
    assert rows[5].support == 0 and rows[5].recall == 0.0
    assert rows[3].f1 == pytest.approx(2 * (4 / 6) * (4 / 5) / (4 / 6 + 4 / 5))
    assert evaluation.accuracy(pairs).head()[0] == 9 / 15
    averages = {r.average: r for r in evaluation.report_averages(pairs).collect()}
    assert averages["macro avg"].recall == pytest.approx((5 / 7 + 4 / 5 + 0 + 0) / 4)
    assert averages["weighted avg"].recall == pytest.approx(9 / 15)
    assert averages["weighted avg"].support == 15
    assert averages["accuracy"].f1 == pytest.approx(9 / 15) and averages["accuracy"].precision is None


def test_rows_without_a_label_do_not_count(spark, pairs):
    more = pairs.unionByName(spark.createDataFrame([(None, 2), (2, None), (None, None)], "actual int, predicted int"))
    for metric in (evaluation.confusion_matrix, evaluation.classification_report, evaluation.accuracy):
        assert sorted(metric(more).collect()) == sorted(metric(pairs).collect())


def test_matrix_scans_its_table_once(spark, tmp_path):
    spark.createDataFrame(PAIRS, "actual int, predicted int").write.parquet(str(tmp_path / "p"))
    df = spark.read.parquet(str(tmp_path / "p"))
    for mode in evaluation.NORMALIZE:
        matrix = evaluation.confusion_matrix(df, normalize=mode)
        matrix.collect()
        final = matrix._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        # the plan shows the scan once at most: the other uses read the same shuffle
        assert final.count("FileScan") <= 1 and "ReusedExchange" in final


def test_empty_evaluation(pairs):
    none = pairs.where("actual > 99")
    assert evaluation.accuracy(none).head()[0] == 0.0
    assert evaluation.success_ratio(evaluation.add_hits(none)).head().total == 0


def test_range(pairs):
    assert tuple(evaluation.prediction_range(pairs).head()) == (1.0, 2.0, 1.0, 2.5)


@pytest.fixture(scope="module")
def scored(spark):
    return spark.createDataFrame(
        [("a", 1.0, [0.1, 0.7, 0.2]), ("b", 1.5, [0.4, 0.4, 0.2]), ("c", 2.0, [0.0, 0.1, 0.9])],
        "photo_file string, stars double, probability array<double>",
    )


def test_top_classes_best_last_and_ties_to_the_higher(scored):
    got = {r.photo_file: [t.class_idx for t in r.top] for r in evaluation.top_classes(scored, k=2).collect()}
    assert got == {"a": [2, 1], "b": [0, 1], "c": [1, 2]}


@pytest.fixture(scope="module")
def classes(spark):
    return spark.createDataFrame([(0, "1_0", 1.0), (1, "1_5", 1.5), (2, "2_0", 2.0)], "class_idx int, cat string, stars double")


def test_categorical_evaluation(scored, classes):
    decoded = evaluation.decode_categorical(scored, classes)
    assert {r.photo_file: (r.cat, r.predicted) for r in decoded.collect()} == {
        "a": ("1_5", 3), "b": ("1_5", 3), "c": ("2_0", 4)
    }
    report = evaluate_predictions(scored, classes)
    assert report.accuracy.head()[0] == pytest.approx(2 / 3)
    assert report.confusion.agg(F.sum("value")).head()[0] == 3
    assert report.frequency.count() == 3
    with pytest.raises(ValueError):
        evaluate_predictions(scored)


def test_predictions_are_held_against_their_truth(spark, scored, classes):
    truth = scored.select("photo_file", "stars", F.ascii("photo_file").alias("at"))
    predicted = scored.select("photo_file", "probability", F.lit("x").alias("stars"), (F.ascii("photo_file") * 2).alias("place"))
    whole = evaluate_predictions(scored, classes)
    for report in (
        evaluate_predictions(predicted, classes, truth=truth),
        evaluate_predictions(predicted, classes, truth=truth, order=("at",), predicted_order=("place",)),
    ):
        for name in ("frequency", "range", "confusion", "accuracy", "report", "averages"):
            assert getattr(report, name).exceptAll(getattr(whole, name)).count() == 0
    shifted = predicted.withColumn("place", F.when(F.col("photo_file") == "a", 999).otherwise(F.col("place")))
    for wrong in (shifted, predicted.where("photo_file <> 'c'"), predicted.unionByName(predicted.withColumns({"photo_file": F.lit("z"), "place": F.col("place") + 500}))):
        with pytest.raises(Exception, match="unexpected row at position"):
            evaluate_predictions(wrong, classes, truth=truth, order=("at",), predicted_order=("place",))
    with pytest.raises(Exception, match="row in one table only"):
        evaluate_predictions(predicted.where("photo_file <> 'b'"), classes, truth=truth)
    with pytest.raises(ValueError, match="order of both"):
        evaluate_predictions(predicted, classes, truth=truth, order=("at",))


def test_reports_follow_from_one_table_of_counts(spark, scored, classes):
    reads = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def read(name):
        reads.add(1)
        return name

    report = evaluate_predictions(scored.withColumn("photo_file", read.asNondeterministic()("photo_file")).where("photo_file is not null"), classes)
    for frame in (report.frequency, report.range, report.confusion, report.accuracy, report.report, report.averages):
        frame.collect()
    assert reads.value == scored.count()


def test_empty_verification_split_warns(spark):
    from listing_analytics.operators.splits import Split

    one = spark.createDataFrame([("b", "p")], "business_id string, photo_id string")
    with pytest.warns(UserWarning, match="verification split"):
        split_dataset(one, Split(0.5, 0.0))


def test_ordinal_outputs_round_half_to_even(spark):
    df = spark.createDataFrame([([0.5, 1.5, 0.49, 0.51],), ([1.0] * 8,)], "probability array<double>")
    assert sorted(r.predicted for r in evaluation.decode_ordinal(df, base=1).collect()) == [4, 9]
    assert max(r.predicted for r in evaluation.decode_ordinal(df, base=2).collect()) == 10


def test_list_hits(spark):
    df = spark.createDataFrame([([1, 0], [1, 0]), ([1, 0], [1, 1])], "actual array<int>, predicted array<int>")
    assert tuple(evaluation.success_ratio(evaluation.add_hits(df)).head()) == (1, 2, 0.5)


def test_frequency_table_ignores_missing(spark):
    df = spark.createDataFrame([(1.0, "x"), (1.0, "y"), (2.0, "x"), (None, "x")], "stars double, split string")
    assert {r.stars: (r["count"], r.percent) for r in profile.frequency_table(df, "stars").collect()} == {
        1.0: (2, 2 / 3), 2.0: (1, 1 / 3)
    }
    by = profile.frequency_table(df, "stars", by="split").collect()
    assert {(r.split, r.stars): r.percent for r in by} == {("x", 1.0): 0.5, ("x", 2.0): 0.5, ("y", 1.0): 1.0}


def test_value_counts_order(spark):
    df = spark.createDataFrame([(3,), (1,), (3,), (2,), (None,)], "width int")
    assert [tuple(r) for r in profile.value_counts(df, "width").collect()] == [(3, 2), (1, 1), (2, 1)]


def test_observed_counts(spark):
    df, counts = profile.observed(spark.range(10), "m", even=F.col("id") % 2 == 0)
    df.collect()
    assert counts.get == {"rows": 10, "even": 5}


def test_class_sets(spark):
    df = spark.createDataFrame([("a", "train"), ("a", "validation"), ("b", "train"), ("c", "verify")], "cat string, split string")
    assert {r.cat: r.matches for r in profile.class_sets(df, "cat").collect()} == {"a": 1, "b": 0}
    with pytest.raises(ValueError, match="'b'"):
        profile.require_same_classes(df, "cat")
    profile.require_same_classes(df.where("cat = 'a'"), "cat")


def test_histories(spark):
    df = spark.createDataFrame(
        [("m", "r1", 1, 0.5, 0.9), ("m", "r1", 2, 0.6, 0.4), ("m", "r2", 1, 0.7, 0.4), ("n", "r3", 1, 0.1, None)],
        "model string, run_id string, epoch int, accuracy double, val_loss double",
    )
    last = history.last_epoch(df, ["run_id"], "epoch", ["accuracy"]).collect()
    assert {r.run_id: (r.epoch, r.accuracy) for r in last} == {"r1": (2, 0.6), "r2": (1, 0.7), "r3": (1, 0.1)}
    best = history.best_epoch(df, ["model"], "val_loss", ["accuracy"], ["epoch"]).collect()
    assert [(r.model, r.val_loss, r.epoch, r.accuracy) for r in best] == [("m", 0.4, 1, 0.7)]


def test_split_dataset_in_order(spark):
    df = spark.createDataFrame([(f"b{i % 3}", f"p{i:03}", 1.0 + i % 2) for i in range(100)],
                               "business_id string, photo_id string, stars double")
    got = split_dataset(df, Split(0.05, 0.2), photo_limit=80, sample=0.5)
    counts = {r.split: r["count"] for r in got.groupBy("split").count().collect()}
    assert counts == {"train": 30, "validation": 8, "verify": 2}
    rows = got.orderBy("ordinal").collect()
    assert [(r.business_id, r.photo_id) for r in rows] == sorted((r.business_id, r.photo_id) for r in rows)
    tables = split_frequencies(got)
    assert tables["total"].agg(F.sum("count")).head()[0] == 38
    assert tables["by_split"].agg(F.sum("percent")).head()[0] == pytest.approx(2.0)
