"""Centroid clustering over a vector approximation file (VA-file).

Every dimension is cut into `2 ** BITS` cells at quantiles of a bounded sample; the extremes of all vectors bound the outer
cells. The file holds, for each vector, the cells of its components in a byte each, two in a byte up to four bits, and
beside them the vector itself as packed integers. A round turns the centroids into lookup tables: for each dimension, cell and centroid, the least and
the greatest squared difference, less that to the centroids' mean, which is common to all and only widens the intervals. Sums
of table entries bound a vector's distance to each centroid from below and above. Where only one centroid's lower bound is within the least upper bound, it is the nearest and the vector itself is not looked at;
else exact integer distances to the centroids whose intervals overlap decide. The update needs the exact sum of each
cluster's vectors, which a segmented sum of the packed integers takes in the same pass, so a round is one scan and its
shuffle is at most `k * (dimensions + 2)` numbers a task. Centroids, cell bounds and tables have a fixed size, whatever the data's.

All arithmetic is on integers, so results do not depend on the partitioning. Components of 2**27 or more after scaling
would leave 64 bits as squared distances and end the job with an error.

Defined cases: vectors that are null, of another length, or hold a null or non-finite component take no part and have no row.
Each given row has a row of its own, also where ids repeat or vectors are equal; a null id is hashed as empty text.
Rows whose ids hash alike are taken as initial centroids in the order of their components. Fewer vectors than `k` are as many
centroids; a table without any has an empty result. Other columns make no difference.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from listing_analytics.staging import stage

K = 40
ROUNDS = 5
DIMENSIONS = 64
SCALE = 256
SEED = 2
#: Fewer than 5 leave nearly all intervals of 64 weakly ordered dimensions overlapping.
BITS = 6
#: Vectors that the cell bounds are drawn from, those with the smallest hashes.
SAMPLE = 4096
#: Vectors whose intervals are held at once, and pairs of a vector and a centroid that are compared at once.
BLOCK, PAIRS = 4096, 1 << 16
_LIMIT = 1 << 27
_RESULT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def kept(vectors: DataFrame, dimensions: int, id_column: str, vector_column: str) -> DataFrame:
    """`vec_id, vector` of the rows that take part."""
    vector = F.col(f"`{vector_column}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{id_column}`").cast("long").alias("vec_id"), vector.alias("vector"))
    sound = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return rows.where((F.size("vector") == dimensions) & F.coalesce(sound, F.lit(False)))


def matrix(column: pa.Array, dimensions: int, scale: int) -> np.ndarray:
    """The scaled components of vectors, rounded down."""
    found = np.floor(scale * column.flatten().to_numpy(zero_copy_only=False)).reshape(len(column), dimensions)
    if len(found) and np.abs(found).max() >= _LIMIT:
        raise ValueError(f"a component times {scale} is {_LIMIT} or more: its squared distances would leave 64 bits")
    return found.astype(np.int32)


def binary(rows: np.ndarray) -> pa.Array:
    """Rows of a matrix as binary values."""
    width = rows.shape[1] * rows.itemsize
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows))])


def from_binary(column: pa.Array, kind, width: int) -> np.ndarray:
    """The matrix of such a column."""
    offsets = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, 4 * column.offset)
    start = int(offsets[0])
    return np.frombuffer(column.buffers()[2], kind, (int(offsets[-1]) - start) // np.dtype(kind).itemsize, start).reshape(-1, width)


@dataclass(frozen=True)
class Cells:
    """Bounds of the cells: dimension d's cell j reaches from `low[d, j]` to `high[d, j]`."""

    low: np.ndarray
    high: np.ndarray

    @classmethod
    def fit(cls, sample: np.ndarray, least: np.ndarray, greatest: np.ndarray, bits: int) -> Cells:
        n = 1 << bits
        at = (np.arange(1, n) * len(sample)) // n
        inner = np.sort(sample, axis=0)[at].T.astype(np.int64)  # cell j + 1 begins at inner[:, j]
        low = np.concatenate((least[:, None], inner), axis=1)
        high = np.concatenate((inner - 1, greatest[:, None]), axis=1)
        return cls(low, high)

    def place(self, rows: np.ndarray) -> np.ndarray:
        """The cell of each component."""
        found = np.empty(rows.shape, np.uint8)
        for d in range(rows.shape[1]):
            found[:, d] = np.searchsorted(self.low[d, 1:], rows[:, d], "right")
        return found

    def tables(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest squared difference to each centroid, less that to the centroids' mean, by dimension and cell.

        What is taken off is the same for all centroids of a vector, and what is left changes little within a cell.
        """
        mean = np.rint(centroids.mean(axis=0)).astype(np.int64)
        fixed, slope = (centroids ** 2 - mean ** 2).T[:, None, :], 2 * (centroids - mean).T[:, None, :]
        ends = [fixed - slope * x[:, :, None] for x in (self.low, self.high)]
        least, greatest = np.minimum(*ends), np.maximum(*ends)
        small = np.maximum(np.abs(least), np.abs(greatest)).max(axis=(1, 2)).sum() < 1 << 31
        kind = np.int32 if small else np.int64
        return least.astype(kind), greatest.astype(kind)


def packed(cells: np.ndarray, bits: int) -> np.ndarray:
    """Cells of up to four bits, two in a byte."""
    if bits > 4:
        return cells
    if cells.shape[1] % 2:
        cells = np.pad(cells, ((0, 0), (0, 1)))
    return cells[:, ::2] | cells[:, 1::2] << 4


def unpacked(rows: np.ndarray, bits: int, dimensions: int) -> np.ndarray:
    """Cells by dimension, one row for each dimension."""
    if bits > 4:
        return rows.T
    found = np.empty((2 * rows.shape[1], len(rows)), np.uint8)
    found[::2], found[1::2] = (rows & 15).T, (rows >> 4).T
    return found[:dimensions]


def nearest(cells: np.ndarray, rows: np.ndarray, centroids: np.ndarray, tables: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each vector, ties to the first, and which vectors had to be looked at.

    `cells` has a row for each dimension; `rows` is read only where intervals overlap.
    """
    least, greatest = tables
    lower = np.zeros((len(rows), len(centroids)), least.dtype)
    upper = np.zeros_like(lower)
    for d, own in enumerate(cells):
        lower += least[d].take(own, axis=0)
        upper += greatest[d].take(own, axis=0)
    near = lower <= upper.min(axis=1)[:, None]
    found = near.argmax(axis=1)
    fetched = near.sum(axis=1) > 1
    open_ = np.flatnonzero(fetched)
    row, centroid = np.nonzero(near[open_])
    distance = np.empty(len(row), np.int64)
    for lo in range(0, len(row), PAIRS):
        part = slice(lo, lo + PAIRS)
        apart = rows[open_[row[part]]].astype(np.int64) - centroids[centroid[part]]
        distance[part] = np.einsum("ij,ij->i", apart, apart)
    if len(open_):
        begins = np.searchsorted(row, np.arange(len(open_)))
        least_of_row = np.minimum.reduceat(distance, begins)
        hit = np.flatnonzero(distance == least_of_row[row])
        first = hit[np.searchsorted(row[hit], np.arange(len(open_)))]
        found[open_] = centroid[first]
    return found, fetched


class VAFile:
    """The file of a table of vectors, written to the shared folder, and the initial centroids."""

    def __init__(
        self, vectors: DataFrame, k: int = K, dimensions: int = DIMENSIONS, scale: int = SCALE, seed: int = SEED, bits: int = BITS,
        id_column: str = "vec_id", vector_column: str = "embedding",
    ):
        if not 1 <= bits <= 8:
            raise ValueError(f"cells have 1 to 8 bits, not {bits}")
        self.dimensions, self.bits = dimensions, bits
        rows = kept(vectors, dimensions, id_column, vector_column)

        def extremes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n, least, greatest = 0, np.full(dimensions, _LIMIT, np.int64), np.full(dimensions, -_LIMIT, np.int64)
            for batch in batches:
                found = matrix(batch.column("vector"), dimensions, scale)
                n += len(found)
                if len(found):
                    least, greatest = np.minimum(least, found.min(0)), np.maximum(greatest, found.max(0))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(dimensions, dtype=np.int32)), pa.array(np.full(dimensions, n)), pa.array(least), pa.array(greatest)],
                ["d", "n", "least", "greatest"],
            )

        found = (
            rows.select("vector").mapInArrow(extremes, "d int, n long, least long, greatest long").groupBy("d")
            .agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.max("greatest").alias("greatest")).orderBy("d").collect()
        )
        self.n = found[0].n if found else 0
        if not self.n:
            return
        sample = self._sample(rows, max(k, SAMPLE), k, f"{seed}:")
        ints = np.floor(scale * np.array(sample)).astype(np.int64)
        self.initial = ints[:k]
        self.cells = Cells.fit(ints, np.array([r.least for r in found]), np.array([r.greatest for r in found]), bits)
        cells = self.cells

        def approximate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                full = matrix(batch.column("vector"), dimensions, scale)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), binary(packed(cells.place(full), bits)), binary(full)], ["vec_id", "cells", "vector"]
                )

        self.file = stage(rows.mapInArrow(approximate, "vec_id long, cells binary, vector binary"), "vafile")

    def _sample(self, rows: DataFrame, size: int, least: int, prefix: str) -> list:
        """The `size` vectors of the smallest hashes, or as many as a first share of the hashes has, `least` at least."""
        digest = F.sha2(F.concat(F.lit(prefix), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
        share = min(1.0, 4 * size / self.n)
        while True:
            below = F.conv(F.substring("hash", 1, 12), 16, 10).cast("long") < int(share * 16 ** 12)
            found = rows.withColumn("hash", digest).where(below).orderBy("hash", "vec_id", "vector").limit(size).collect()
            if len(found) >= min(least, self.n):
                return [r.vector for r in found]
            share = min(1.0, 8 * share)

    def _blocks(self, batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
        width = (self.dimensions + 1) // 2 if self.bits <= 4 else self.dimensions
        for lo in range(0, len(batch), BLOCK):
            part = batch.slice(lo, BLOCK)
            cells = unpacked(from_binary(part.column("cells"), np.uint8, width), self.bits, self.dimensions)
            yield part, cells, from_binary(part.column("vector"), np.int32, self.dimensions)

    def _mapper(self):
        """What the workers need: this object without its table."""
        own = object.__new__(VAFile)
        own.dimensions, own.bits = self.dimensions, self.bits
        return own

    def round(self, centroids: np.ndarray) -> tuple[np.ndarray, int]:
        """The centroids after one assignment and update, and how many vectors the assignment had to look at."""
        own, tables, dimensions = self._mapper(), self.cells.tables(centroids), self.dimensions

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            totals = np.zeros((len(centroids), dimensions + 2), np.int64)  # sums, vectors, vectors looked at
            for batch in batches:
                for _, cells, rows in own._blocks(batch):
                    cluster, fetched = nearest(cells, rows, centroids, tables)
                    order = np.argsort(cluster, kind="stable")
                    used, begins = np.unique(cluster[order], return_index=True)
                    totals[used, :dimensions] += np.add.reduceat(rows[order].astype(np.int64), begins, axis=0)
                    totals[:, dimensions] += np.bincount(cluster, minlength=len(centroids))
                    totals[:, dimensions + 1] += np.bincount(cluster[fetched], minlength=len(centroids))
            cluster, place = np.nonzero(totals)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cluster.astype(np.int32)), pa.array(place.astype(np.int32)), pa.array(totals[cluster, place])], ["cluster", "place", "total"]
            )

        parts = self.file.select("cells", "vector").mapInArrow(run, "cluster int, place int, total long")
        totals = [[0] * (dimensions + 2) for _ in centroids]
        for r in parts.groupBy("cluster", "place").agg(F.sum("total").alias("total")).collect():  # k * (dimensions + 2) rows at most
            totals[r.cluster][r.place] = r.total
        moved = [
            [s // t[dimensions] for s in t[:dimensions]] if t[dimensions] else old.tolist() for t, old in zip(totals, centroids)
        ]
        return np.array(moved, np.int64), sum(t[dimensions + 1] for t in totals)

    def assign(self, centroids: np.ndarray) -> DataFrame:
        """`vec_id, cluster, distance` of every vector."""
        own, tables = self._mapper(), self.cells.tables(centroids)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part, cells, rows in own._blocks(batch):
                    cluster, _ = nearest(cells, rows, centroids, tables)
                    apart = rows.astype(np.int64) - centroids[cluster]
                    yield pa.RecordBatch.from_arrays(
                        [part.column("vec_id"), pa.array(cluster.astype(np.int32)), pa.array(np.einsum("ij,ij->i", apart, apart))],
                        ["vec_id", "cluster", "distance"],
                    )

        return self.file.mapInArrow(run, "vec_id long, cluster int, distance long")


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, **options) -> DataFrame:
    """`vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256` of every vector that takes part.

    `options` are those of `VAFile`.
    """
    spark = vectors.sparkSession
    file = VAFile(vectors, k, **options)
    if not file.n:
        return spark.createDataFrame([], _RESULT)
    centroids = file.initial
    for _ in range(rounds):
        centroids, _ = file.round(centroids)
    assigned = stage(file.assign(centroids), "assigned")
    inertia = {r.cluster: r.n for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("n")).collect()}
    total = sum(inertia.values())
    rows = [
        (c, n, total, hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()) for c, n in inertia.items()
    ]
    clusters = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # one row for each centroid
    return assigned.join(F.broadcast(clusters), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
