"""Models on feature vectors: classifier heads, ordinal targets, kernel features, parameter search."""

from __future__ import annotations

import math
import random
from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import LinearSVC, LogisticRegression, MultilayerPerceptronClassifier, OneVsRest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from listing_analytics.functions import vectors
from listing_analytics.operators.kernel import Projection, project
from listing_analytics.sources.tables import quoted
from listing_analytics.staging import stage, stage_path

FEATURES, LABEL = "features", "label"


def with_features(df: DataFrame, column: str, label: str | None = None) -> DataFrame:
    """Add the ML vector `features` and, from an index column, the double `label`."""
    df = df.withColumn(FEATURES, array_to_vector(vectors.doubles(F.col(quoted(column)))))
    return df if label is None else df.withColumn(LABEL, F.col(quoted(label)).cast("double"))


def layer_sizes(train: DataFrame, hidden: Sequence[int]) -> list[int]:
    """Inputs, hidden units and classes of a dense network on `train`."""
    one = train.agg(
        F.max(F.size(vector_to_array(FEATURES))).alias("inputs"), F.max(LABEL).alias("top")
    ).head()
    return [one["inputs"], *hidden, int(one["top"]) + 1]


def dense_head(train: DataFrame, hidden: Sequence[int] = (128,), epochs: int = 100, seed: int = 1) -> Estimator:
    """Dense layers ending in a softmax over the classes."""
    return MultilayerPerceptronClassifier(
        featuresCol=FEATURES, labelCol=LABEL, layers=layer_sizes(train, hidden), maxIter=epochs, seed=seed
    )


def softmax_head(train: DataFrame, epochs: int = 100, seed: int = 1) -> Estimator:
    """One softmax layer."""
    return LogisticRegression(featuresCol=FEATURES, labelCol=LABEL, maxIter=epochs, family="multinomial")


def svm_head(train: DataFrame, epochs: int = 100, seed: int = 1) -> Estimator:
    """One linear machine per class with hinge loss; feed it `fourier_features` for a kernel machine."""
    machine = LinearSVC(featuresCol=FEATURES, labelCol=LABEL, maxIter=epochs, regParam=1e-4)
    return OneVsRest(featuresCol=FEATURES, labelCol=LABEL, classifier=machine)


# Model functions by name: each takes the training rows and returns an estimator.
MODELS = {"dense": dense_head, "softmax": softmax_head, "svm": svm_head}


def saved(model: Model) -> Model:
    """The model as written to the shared folder and read back.

    A fresh two-class model carries its training summary, and with it the whole session, into
    every task of a prediction; that fails once the session has observed a row count.
    """
    path = stage_path(SparkSession.active(), "model")
    model.write().save(path)
    return type(model).load(path)


def estimator_for(train: DataFrame, model: str, **options) -> Estimator:
    """The estimator of the model function of that name."""
    if model not in MODELS:
        raise ValueError(f"model {model!r} could not be found; expected one of {sorted(MODELS)}")
    return MODELS[model](train, **options)


def losses(model: Model) -> list[float]:
    """The training objective after every iteration, where the fresh model has recorded it."""
    return list(model.summary.objectiveHistory) if getattr(model, "hasSummary", False) else []


def train_model(train: DataFrame, model: str = "dense", **options) -> Model:
    """Fit the model of that name on `features` and `label`."""
    return saved(estimator_for(train, model, **options).fit(train))


def predict(model: Model, df: DataFrame) -> DataFrame:
    """Add `prediction` and, where the model has one, `probability` as an array."""
    out = model.transform(df)
    if "probability" in out.columns:
        out = out.withColumn("probability", vector_to_array("probability"))
    return out.drop("rawPrediction")


def train_ordinal(train: DataFrame, targets: Sequence[str], epochs: int = 100) -> list[Model]:
    """One binary model per threshold column `t0, t1, ...`."""
    rows = train.select(FEATURES, *[F.col(quoted(t)).cast("double").alias(t) for t in targets]).persist()
    try:
        return [
            saved(LogisticRegression(featuresCol=FEATURES, labelCol=t, maxIter=epochs, family="binomial").fit(rows))
            for t in targets
        ]
    finally:
        rows.unpersist()


def predict_ordinal(models: Iterable[Model], df: DataFrame) -> DataFrame:
    """Add `probability`: for each threshold, the probability that it is passed."""
    passed = []
    for i, model in enumerate(models):
        out = f"_p{i}"
        df = model.copy().setProbabilityCol(out).setRawPredictionCol("").setPredictionCol("").transform(df)
        passed.append(F.get(vector_to_array(out), F.lit(1)))
    return df.withColumn("probability", F.array(*passed)).drop(*[f"_p{i}" for i in range(len(passed))])


def fourier_features(
    df: DataFrame, column: str, dims: int = 4096, scale: float = 10.0, seed: int = 1, out: str = FEATURES
) -> DataFrame:
    """Add random Fourier features of a Gaussian kernel: cosines of a seeded random projection."""
    inputs = df.agg(F.max(F.size(quoted(column)))).head()[0]

    projection = Projection(inputs or 0, dims, scale, seed)

    @F.pandas_udf("array<double>")
    def features(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        drawn = projection.draw()  # once a task
        for rows in batches:
            yield pd.Series(list(project(np.stack(rows.to_numpy()).astype(float), drawn)) if len(rows) else [], dtype=object)

    return df.withColumn(out, array_to_vector(features(vectors.doubles(F.col(quoted(column))))))


@dataclass(frozen=True)
class Trial:
    """A setting, its score in the last round it was fitted in, and the number of rounds."""

    trial: int
    params: dict[str, str]
    score: float
    rounds: int = 1


@dataclass(frozen=True)
class Halving:
    """Fit all settings with `least` of the parameter `param` first, the best of them with `factor` times as much, up to `most`."""

    param: str
    least: int
    most: int
    factor: int = 3

    def __post_init__(self):
        if not (1 <= self.least <= self.most and self.factor >= 2):
            raise ValueError("halving needs 1 <= least <= most and a factor of 2 at least")

    def budgets(self) -> list[int]:
        found = [self.least]
        while found[-1] < self.most:
            found.append(min(self.most, found[-1] * self.factor))
        return found


def draw_settings(space: Mapping[str, Sequence], n: int, seed: int = 1) -> list[dict[str, object]]:
    """Up to `n` different settings of `space`, without building them all: numbers of settings are drawn and taken apart.

    The values of a parameter are the digits of a number with one place for each parameter, the last one changing fastest.
    """
    values = {name: list(choices) for name, choices in space.items()}
    total = math.prod(map(len, values.values()))
    rng = random.Random(seed)
    if total < 1 << 62:
        numbers = rng.sample(range(total), min(n, total))
    else:
        numbers = []
        while len(numbers) < n:
            number = rng.randrange(total)
            if number not in numbers:
                numbers.append(number)
    settings = []
    for number in numbers:
        digits = {}
        for name in reversed(values):
            number, digit = divmod(number, len(values[name]))
            digits[name] = values[name][digit]
        settings.append({name: digits[name] for name in values})
    return settings


def random_search(
    train: DataFrame,
    estimator: Estimator,
    space: Mapping[str, Sequence],
    max_trials: int,
    executions: int = 1,
    validation: float = 0.2,
    seed: int = 1,
    parallelism: int = 2,
    halving: Halving | None = None,
) -> list[Trial]:
    """Fit randomly drawn settings of `space`; each score is the mean validation accuracy of its runs.

    Every run splits the rows anew. Up to `parallelism` settings are fitted at a time. With `halving` only the best of a round
    are fitted again, with more. Trials are returned best first, those of later rounds before others.
    """
    drawn = draw_settings(space, max_trials, seed)
    evaluator = MulticlassClassificationEvaluator(labelCol=LABEL, metricName="accuracy")
    rows = stage(train.select(FEATURES, LABEL), "search")
    scores, rounds = np.zeros(len(drawn)), np.zeros(len(drawn), int)

    def fit_all(places: list[int], more: Mapping[str, object]) -> None:
        scores[places] = 0
        rounds[places] += 1
        for run in range(executions):
            fit_rows, check_rows = (part.persist() for part in rows.randomSplit([1 - validation, validation], seed + run))

            def score(place: int) -> float:
                setting = {estimator.getParam(name): value for name, value in {**drawn[place], **more}.items()}
                return evaluator.evaluate(saved(estimator.fit(fit_rows, setting)).transform(check_rows))

            with ThreadPool(parallelism) as pool:
                scores[places] += np.array(pool.map(score, places)) / executions
            fit_rows.unpersist()
            check_rows.unpersist()

    left = list(range(len(drawn)))
    for i, budget in enumerate(halving.budgets() if halving else [None]):
        if i:
            left = sorted(left, key=lambda t: (-scores[t], t))[:max(1, len(left) // halving.factor)]
        fit_all(left, {halving.param: budget} if halving else {})
    trials = [Trial(i, {n: str(v) for n, v in setting.items()}, float(scores[i]), int(rounds[i])) for i, setting in enumerate(drawn)]
    return sorted(trials, key=lambda t: (-t.rounds, -t.score, t.trial))
