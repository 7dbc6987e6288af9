"""A kernel machine: random Fourier features under linear machines with squared hinge loss, fitted in distributed passes.

A pass sends the parameters out and brings back the loss and its gradient. Each task draws the projection once from
its seed, walks over its rows in blocks and hands on one packed vector; these are added in two steps, so neither the driver nor
a task receives one from every task. The driver keeps the last few parameter and gradient differences and turns a
gradient into a step (limited-memory BFGS). The objective is convex, so its least value does not depend on the start.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from listing_analytics.functions import vectors
from listing_analytics.operators.filters import require_columns
from listing_analytics.sources.tables import quoted
from listing_analytics.staging import stage

DIMS = 4096
SCALE = 10.0
L2 = 1e-4
ITERATIONS = 100
TOLERANCE = 1e-3
MEMORY = 10
#: Rows that a task projects at once.
BLOCK = 1024
_SUFFICIENT, _SHRINK, _TRIES = 1e-4, 0.5, 30


@dataclass(frozen=True)
class Projection:
    """A seeded random projection; its cosines are random Fourier features of a Gaussian kernel of width `scale`."""

    inputs: int
    dims: int = DIMS
    scale: float = SCALE
    seed: int = 1

    def draw(self) -> tuple[np.ndarray, np.ndarray]:
        rng = np.random.default_rng(self.seed)
        weights = rng.standard_normal((self.inputs, self.dims)) / self.scale
        return weights, rng.uniform(0, 2 * np.pi, self.dims)


def project(rows: np.ndarray, drawn: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    weights, shift = drawn
    return np.cos(rows @ weights + shift)


def loss_sums(rows: np.ndarray, labels: np.ndarray, theta: np.ndarray) -> tuple[float, np.ndarray]:
    """Sums over rows of the squared hinge loss, mean over classes, and of its gradient; the last row of `theta` is the bias."""
    margins = rows @ theta[:-1] + theta[-1]
    signs = np.where(labels[:, None] == np.arange(theta.shape[1]), 1.0, -1.0)
    short = np.maximum(0.0, 1.0 - signs * margins)
    slope = -2.0 * signs * short / theta.shape[1]
    return float((short ** 2).sum() / theta.shape[1]), np.vstack([rows.T @ slope, slope.sum(axis=0)])


def objective(loss: float, gradient: np.ndarray, n: int, theta: np.ndarray, l2: float) -> tuple[float, np.ndarray]:
    """Mean loss and gradient with the penalty on all but the bias."""
    penalty = 2 * l2 * theta
    penalty[-1] = 0
    return loss / n + l2 * float((theta[:-1] ** 2).sum()), gradient / n + penalty


class LimitedMemory:
    """Steps from the last `memory` differences of parameters and gradients."""

    def __init__(self, memory: int = MEMORY):
        self.pairs: list[tuple[np.ndarray, np.ndarray]] = []
        self.memory = memory

    def add(self, step: np.ndarray, change: np.ndarray) -> None:
        if (step * change).sum() > 1e-12 * (change * change).sum():
            self.pairs = [*self.pairs, (step, change)][-self.memory:]

    def direction(self, gradient: np.ndarray) -> np.ndarray:
        found, shares = -gradient, []
        for step, change in reversed(self.pairs):
            share = (step * found).sum() / (step * change).sum()
            found = found - share * change
            shares.append(share)
        if self.pairs:
            step, change = self.pairs[-1]
            found = found * ((step * change).sum() / (change * change).sum())
        for (step, change), share in zip(self.pairs, reversed(shares)):
            found = found + (share - (change * found).sum() / (step * change).sum()) * step
        return found


def minimise(evaluate, theta: np.ndarray, iterations: int = ITERATIONS, tolerance: float = TOLERANCE) -> tuple[np.ndarray, list[float]]:
    """The parameters of least value and the value after every step, until the gradient has shrunk to `tolerance` of its first size."""
    value, gradient = evaluate(theta)
    history, memory, first = [value], LimitedMemory(), np.linalg.norm(gradient)
    for _ in range(iterations):
        if np.linalg.norm(gradient) <= tolerance * first:
            break
        direction = memory.direction(gradient)
        slope = (direction * gradient).sum()
        if slope >= 0:  # what is remembered misleads
            memory, direction = LimitedMemory(), -gradient
            slope = -(gradient * gradient).sum()
        length = 1.0 if memory.pairs else min(1.0, 1.0 / max(np.linalg.norm(gradient), 1e-12))
        for _ in range(_TRIES):
            moved = theta + length * direction
            new_value, new_gradient = evaluate(moved)
            if new_value <= value + _SUFFICIENT * length * slope:
                break
            length *= _SHRINK
        else:
            break
        if new_value >= value:  # rounding hides what further steps gain
            break
        memory.add(moved - theta, new_gradient - gradient)
        theta, value, gradient = moved, new_value, new_gradient
        history.append(value)
    return theta, history


def packed_sums(rows: DataFrame, size: int, groups: int, run) -> np.ndarray:
    """The sum of the vectors of `size` numbers that `run` makes of the batches of each task, added in `groups` tasks, then here."""

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array([run(batches).astype("<f8").tobytes()], pa.binary())], ["sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for sums in batch.column("sums"):  # sorted by task
                total = (0 if total is None else total) + np.frombuffer(sums.as_py(), "<f8")
        if total is not None:  # a partition that no group fell to sends the driver nothing
            yield pa.RecordBatch.from_arrays([pa.array([total.astype("<f8").tobytes()], pa.binary())], ["sums"])

    tasks = rows.mapInArrow(one, "sums binary").withColumn("task", F.spark_partition_id())
    parts = tasks.repartition(groups, F.col("task") % groups).sortWithinPartitions("task").mapInArrow(add, "sums binary")
    collected = parts.withColumn("group", F.spark_partition_id()).collect()
    return sum((np.frombuffer(r.sums, "<f8") for r in sorted(collected, key=lambda r: r.group)), np.zeros(size))


@dataclass(frozen=True)
class KernelMachine:
    """A fitted machine; `history` is the objective after every step."""

    projection: Projection
    theta: np.ndarray
    history: list[float] = field(default_factory=list)

    def predict(self, df: DataFrame, column: str) -> DataFrame:
        """Add `margins`, one for each class, and `prediction`, the class of the greatest, the higher one of equal ones."""
        projection, theta = self.projection, self.theta

        @F.pandas_udf("array<double>")
        def margins(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            drawn = projection.draw()  # once a task
            for rows in batches:
                parts = [np.zeros((0, theta.shape[1]))]
                for lo in range(0, len(rows), BLOCK):
                    parts.append(project(np.stack(rows.iloc[lo:lo + BLOCK].to_numpy()).astype(float), drawn) @ theta[:-1] + theta[-1])
                yield pd.Series(list(np.concatenate(parts)), dtype=object)

        out = df.withColumn("margins", margins(vectors.doubles(F.col(quoted(column)))))
        best = F.array_max(F.transform("margins", lambda m, i: F.struct(m.alias("m"), i.alias("i"))))
        return out.withColumn("prediction", best["i"].cast("int"))


def fit_kernel_machine(
    train: DataFrame, column: str, label: str, dims: int = DIMS, scale: float = SCALE, l2: float = L2,
    iterations: int = ITERATIONS, tolerance: float = TOLERANCE, seed: int = 1,
) -> KernelMachine:
    """Fit one machine for each class 0, 1, ... of `label` on the vectors in `column`; rows without one of them are left out."""
    require_columns(train, column, label)
    rows = train.select(
        vectors.doubles(F.col(quoted(column))).alias("vector"), F.col(quoted(label)).cast("int").alias("label")
    ).where(F.col("vector").isNotNull() & F.col("label").isNotNull())
    rows = stage(rows, "kernel")
    shape = rows.agg(F.count("*").alias("n"), F.min(F.size("vector")).alias("least"), F.max(F.size("vector")).alias("inputs"),
                     F.min("label").alias("low"), F.max("label").alias("top")).head()
    if not shape.n:
        raise ValueError("no rows to learn from")
    if shape.least != shape.inputs or shape.low < 0:
        raise ValueError("vectors must have one length, and labels count from 0")
    projection, classes = Projection(shape.inputs, dims, scale, seed), shape.top + 1
    size, groups = 1 + (dims + 1) * classes, max(1, math.isqrt(rows.rdd.getNumPartitions()))

    def evaluate(theta: np.ndarray) -> tuple[float, np.ndarray]:
        def run(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
            drawn, total = projection.draw(), np.zeros(size)
            for batch in batches:
                for lo in range(0, len(batch), BLOCK):
                    part = batch.slice(lo, BLOCK)
                    found = part.column("vector").flatten().to_numpy().reshape(len(part), -1)
                    loss, gradient = loss_sums(project(found, drawn), part.column("label").to_numpy(), theta)
                    total[0] += loss
                    total[1:] += gradient.ravel()
            return total

        total = packed_sums(rows, size, groups, run)
        return objective(total[0], total[1:].reshape(dims + 1, classes), shape.n, theta, l2)

    theta, history = minimise(evaluate, np.zeros((dims + 1, classes)), iterations, tolerance)
    return KernelMachine(projection, theta, history)
