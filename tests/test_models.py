"""Vectors and models."""

import numpy as np
import pytest
from pyspark.sql import Observation, functions as F

from listing_analytics.operators import evaluation, kernel, models, projections, vectors
from listing_analytics.operators.splits import Split
from listing_analytics.plans import training
from listing_analytics.sinks import runs


@pytest.fixture(scope="module")
def points(spark):
    """Three well separated classes in four dimensions."""
    rng = np.random.default_rng(1)
    rows = [
        (i, (rng.normal(0, 0.3, 4) + 3 * np.eye(4)[i % 3]).tolist(), i % 3, 1.0 + (i % 3) / 2) for i in range(150)
    ]
    return spark.createDataFrame(rows, "id int, v array<double>, class int, stars double").repartition(4)


def matrix(df, column="v"):
    return np.array([r[column] for r in df.orderBy("id").collect()])


def test_feature_standardisation(points):
    x = matrix(points)
    out = matrix(vectors.standardise_features(points, "v"))
    assert np.allclose(out, (x - x.mean(0)) / (x.std(0) + 1e-6))
    assert np.allclose(matrix(vectors.standardise_features(points, "v", scale=False)), x - x.mean(0))
    over = points.where("class = 0")
    ref = x[[i % 3 == 0 for i in range(150)]]
    assert np.allclose(matrix(vectors.standardise_features(points, "v", over=over)), (x - ref.mean(0)) / (ref.std(0) + 1e-6))


def test_sample_standardisation(points):
    x = matrix(points)
    out = matrix(vectors.standardise_samples(points, "v"))
    assert np.allclose(out, (x - x.mean(1, keepdims=True)) / (x.std(1, keepdims=True) + 1e-6))
    assert np.allclose(matrix(vectors.standardise_samples(points, "v", centre=False)), x / (x.std(1, keepdims=True) + 1e-6))


def test_whitening(points):
    out = matrix(vectors.whiten(points, "v"))
    assert np.allclose(np.cov(out.T, bias=True), np.eye(4), atol=1e-3)
    x = matrix(points)
    centred = x - x.mean(0)
    u, s, _ = np.linalg.svd(centred.T @ centred / len(x))
    assert np.allclose(out, centred @ (u / np.sqrt(s + 1e-6)) @ u.T, atol=1e-6)


@pytest.mark.parametrize("name,options", [("dense", {"hidden": (8,)}), ("softmax", {}), ("svm", {"epochs": 20})])
def test_classifiers_learn(points, name, options):
    data = models.with_features(points, "v", "class")
    out = models.predict(models.train_model(data, name, **options), data)
    assert evaluation.accuracy(out, "label", "prediction").head()[0] > 0.9
    if name != "svm":
        assert out.select(F.size("probability")).distinct().head()[0] == 3


def test_prediction_after_an_observed_count(spark, points):
    spark.range(3).observe(Observation(), F.count("*").alias("n")).collect()
    two = models.with_features(points.where("class < 2"), "v", "class")
    out = models.predict(models.train_model(two, "softmax", epochs=5), two)
    assert evaluation.accuracy(out, "label", "prediction").head()[0] > 0.9


def test_unknown_model(points):
    with pytest.raises(ValueError, match="could not be found"):
        models.train_model(points, "resnet")


def test_ordinal_training(points):
    data = projections.expand_list(models.with_features(projections.add_labels(points), "v"), "stars_ord")
    # the list is one longer than the range of stars
    fitted = models.train_ordinal(data, ["t0", "t1"])
    decoded = evaluation.decode_ordinal(models.predict_ordinal(fitted, data), base=2)
    assert evaluation.accuracy(decoded, "stars_num", "predicted").head()[0] > 0.9


@pytest.fixture(scope="module")
def rated(points):
    shuffled = F.md5(F.col("id").cast("string"))
    return projections.add_labels(points.select(
        shuffled.alias("business_id"), F.col("id").cast("string").alias("photo_id"), "stars", F.col("v").alias("features"),
    ))


def test_training_job(spark, rated, tmp_path):
    spec = training.TrainSpec("softmax", {"epochs": 30}, split=Split(0.2, 0.25), params={"seed": 1})
    trained = training.train_categorical(rated, spec, "r1", out="somewhere")
    assert {r.split: r["count"] for r in trained.rows.groupBy("split").count().collect()} == {
        "train": 90, "validation": 30, "verify": 30
    }
    assert trained.predictions.count() == 30
    assert trained.evaluation.accuracy.head()[0] > 0.9
    assert trained.evaluation.confusion.agg(F.sum("value")).head()[0] == 30
    for _ in range(2):
        training.write_run(trained, str(tmp_path / "run"), str(tmp_path / "log"))
    log = runs.run_log_text(spark.read.parquet(str(tmp_path / "log"))).collect()
    assert len(log) == 2 and log[0].params == "epochs=30;seed=1" and log[0].val_accuracy > 0.9
    assert log[0].epochs == spark.read.parquet(str(tmp_path / "run/epochs")).count() > 1
    assert log[0].loss is not None and log[0].val_loss > 0
    predictions, report = training.predict_saved(spark, str(tmp_path / "run"), rated)
    assert predictions.count() == 150 and report.accuracy.head()[0] > 0.9


def test_training_needs_the_same_classes(rated):
    spec = training.TrainSpec("softmax", split=Split(0.1, 0.2), order=("stars", "photo_id"))
    with pytest.raises(ValueError, match="one split only"):
        training.train_categorical(rated, spec, "r1")


def test_ordinal_training_job(rated):
    fitted, predictions, report = training.train_ordinal(rated, training.TrainSpec(split=Split(0.2, 0.25)))
    assert len(fitted) == 2 and predictions.count() == 30 and report.accuracy.head()[0] > 0.9


def test_fourier_features(points):
    out = models.fourier_features(points, "v", dims=2000, scale=2.0, seed=3)
    x = matrix(points)
    z = np.array([r.features.toArray() for r in out.orderBy("id").collect()]) * np.sqrt(2 / 2000)
    # products of the features approach the Gaussian kernel
    kernel = np.exp(-((x[:, None] - x[None]) ** 2).sum(-1) / (2 * 2.0 ** 2))
    assert np.abs(z @ z.T - kernel).max() < 0.15
    again = models.fourier_features(points.repartition(2), "v", dims=2000, scale=2.0, seed=3)
    assert np.allclose(out.orderBy("id").head().features.toArray(), again.orderBy("id").head().features.toArray())


def test_random_search(points):
    data = models.with_features(points, "v", "class")
    space = {"regParam": [0.0, 0.1, 100.0], "maxIter": [1, 20]}
    trials = models.random_search(data, models.softmax_head(data), space, max_trials=4, executions=2)
    assert len(trials) == 4 and trials == sorted(trials, key=lambda t: (-t.score, t.trial))
    assert trials[0].score > 0.8 and set(trials[0].params) == set(space)
    assert len(models.random_search(data, models.softmax_head(data), {"regParam": [0.0]}, max_trials=9)) == 1


def test_settings_are_drawn_from_large_spaces():
    space = {f"p{i}": list(range(10)) for i in range(9)}
    drawn = models.draw_settings(space, 50, seed=3)
    assert len({tuple(s.values()) for s in drawn}) == 50 and all(list(s) == list(space) for s in drawn)
    assert all(0 <= v < 10 for s in drawn for v in s.values())
    small = models.draw_settings({"a": [1, 2], "b": "xyz"}, 99)
    assert sorted((s["a"], s["b"]) for s in small) == [(a, b) for a in (1, 2) for b in "xyz"]
    huge = models.draw_settings({f"p{i}": range(1000) for i in range(30)}, 5)
    assert len({tuple(s.values()) for s in huge}) == 5
    assert models.draw_settings({"a": []}, 3) == []


def test_halving_stops_trials(points):
    assert models.Halving("maxIter", 2, 18).budgets() == [2, 6, 18] and models.Halving("maxIter", 5, 5).budgets() == [5]
    with pytest.raises(ValueError):
        models.Halving("maxIter", 5, 2)
    data = models.with_features(points, "v", "class")
    space = {"regParam": [0.0, 0.001, 50.0, 100.0], "tol": [1e-6, 1e-4]}
    trials = models.random_search(data, models.softmax_head(data), space, 6, halving=models.Halving("maxIter", 1, 8, 2))
    assert [t.rounds for t in trials] == [4, 2, 2, 1, 1, 1] or [t.rounds for t in trials] == [4, 2, 1, 1, 1, 1]
    assert trials[0].score > 0.9 and float(trials[0].params["regParam"]) < 50
    assert trials == sorted(trials, key=lambda t: (-t.rounds, -t.score, t.trial))


def test_kernel_machine_reaches_the_least_objective(points):
    machine = kernel.fit_kernel_machine(points, "v", "class", dims=60, scale=2.0, l2=1e-2, tolerance=1e-7, iterations=300)
    z = kernel.project(matrix(points), kernel.Projection(4, 60, 2.0, 1).draw())
    y = np.array([i % 3 for i in range(150)])

    def value(theta):
        signs = np.where(y[:, None] == np.arange(3), 1.0, -1.0)
        short = np.maximum(0, 1 - signs * (z @ theta[:-1] + theta[-1]))
        return (short ** 2).mean() + 1e-2 * (theta[:-1] ** 2).sum()

    assert np.isclose(machine.history[-1], value(machine.theta))
    # Newton steps on the rows that fall short, class by class, as reference
    best = np.zeros((61, 3))
    ones = np.hstack([z, np.ones((150, 1))])
    ridge = 1e-2 * np.diag([1.0] * 60 + [0.0])
    for c in range(3):
        sign = np.where(y == c, 1.0, -1.0)
        for _ in range(100):
            short = sign * (ones @ best[:, c]) < 1
            a = ones[short].T @ ones[short] / (150 * 3) + ridge + 1e-12 * np.eye(61)
            best[:, c] = np.linalg.solve(a, ones[short].T @ sign[short] / (150 * 3))
    assert value(machine.theta) <= value(best) * (1 + 1e-4)
    assert all(b <= a for a, b in zip(machine.history, machine.history[1:]))
    out = machine.predict(points, "v")
    assert evaluation.accuracy(out, "class", "prediction").head()[0] > 0.95
    margins = np.array([r.margins for r in out.orderBy("id").collect()])
    assert np.allclose(margins, z @ machine.theta[:-1] + machine.theta[-1])


def test_kernel_machine_of_the_default_size(points):
    machine = kernel.fit_kernel_machine(points, "v", "class", scale=2.0, iterations=15)
    assert machine.theta.shape == (4097, 3) and machine.history[-1] < machine.history[0]
    assert evaluation.accuracy(machine.predict(points, "v"), "class", "prediction").head()[0] > 0.95
    again = kernel.fit_kernel_machine(points.repartition(7), "v", "class", scale=2.0, iterations=15)
    assert np.isclose(machine.history[-1], again.history[-1], rtol=1e-6)
    with pytest.raises(ValueError, match="no rows"):
        kernel.fit_kernel_machine(points.limit(0), "v", "class")
    with pytest.raises(ValueError, match="count from 0"):
        kernel.fit_kernel_machine(points.withColumn("class", F.lit(-1)), "v", "class")
    odd = points.withColumn("v", F.when(F.col("id") > 3, F.col("v"))).withColumn("class", F.when(F.col("id") != 5, F.col("class")))
    assert kernel.fit_kernel_machine(odd, "v", "class", dims=8, iterations=3).theta.shape == (9, 3)


def test_steps_of_limited_memory():
    rng = np.random.default_rng(1)
    a = rng.normal(size=(30, 30))
    a, b = a @ a.T + np.eye(30), rng.normal(size=(30, 1))
    found, history = kernel.minimise(lambda x: (float((0.5 * x.T @ a @ x - b.T @ x).item()), a @ x - b), np.zeros((30, 1)), 500, 1e-9)
    assert np.allclose(found, np.linalg.solve(a, b), atol=1e-6) and len(history) < 300


def test_packed_sums_send_the_driver_a_row_for_each_group_only(spark, monkeypatch):
    frame, sent = type(spark.range(0)), []
    dealt, collect = frame.repartition, frame.collect
    monkeypatch.setattr(frame, "repartition", lambda self, n, *by: dealt(self, max(n, 50), *by))
    monkeypatch.setattr(frame, "collect", lambda self: sent.append(collect(self)) or sent[-1])
    count = lambda batches: np.full(3, float(sum(b.num_rows for b in batches)))
    assert kernel.packed_sums(spark.range(0, 70, 1, 7), 3, 2, count).tolist() == [70.0] * 3
    assert len(sent[0]) == 2
    assert kernel.packed_sums(spark.range(0, 0, 1, 1), 3, 2, count).tolist() == [0.0] * 3
