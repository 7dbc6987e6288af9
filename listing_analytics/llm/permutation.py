"""Approximate nearest neighbours by inner product with a permutation index.

Pivots are drawn from the vectors (a bounded sample, by hash). A vector is represented by its `PREFIX` nearest pivots in
order, and posted in the inverted files of its first `POSTED` pivots. A query opens the files of its nearest `probes`
pivots, ranks what they hold by the Spearman footrule between its order of pivots and theirs (a pivot that is not in
an order counts as just behind its end), and reranks the best `depth` of a file, and all that tie with the last of them,
by the exact inner product in double precision. Its best neighbours over all files follow.

Both numbers are measured in each run. The exact neighbours of up to `SAMPLED` queries come from one pass over all vectors;
`probes` is the least number of files that reaches a share `REACHED` of them, and `depth`, `RERANK` at least, the least
that scores a share `FOUND` of them in the first file that holds them. Where order says little, most files are opened.

Files longer than `FILE_BLOCK` entries, and queries of a file beyond `QUERY_BLOCK`, are cut into blocks by hash, each pair of
blocks a task's group, so neither a popular pivot nor a cluster of equal vectors ends up in one task whole. The number of
pivots grows with the square root of the number of vectors up to `MAX_PIVOTS`.

Defined cases: vectors that are null, zero, without a direction (null, infinite or NaN components) or of another length than
most, and rows without an id, take no part. Rows that share an id are one candidate with the best score; a query
is never its own candidate. An empty table has an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from listing_analytics.staging import stage

MAX_PIVOTS = 1024
PREFIX = 16
POSTED = 6
RERANK = 200
SAMPLED = 64
REACHED, FOUND = 0.99, 0.97
FILE_BLOCK = 4096
QUERY_BLOCK = 1024
SEED = 29


def takes_part(vector: str) -> Column:
    """Not null, no odd component, not zero."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.col(vector).isNotNull() & F.coalesce(sound, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def nearest_pivots(vectors: np.ndarray, pivots: np.ndarray, n: int) -> np.ndarray:
    """The places of the n nearest pivots of each vector, nearest first, ties to the first."""
    return np.argsort(-(vectors @ pivots.T), axis=1, kind="stable")[:, :n]


def footrule(query: np.ndarray, orders: np.ndarray, n_pivots: int) -> np.ndarray:
    """Spearman's footrule of each row of `query` against each of `orders`; both hold prefixes of equal length."""
    size = orders.shape[1]
    place = np.full((len(orders), n_pivots), size, np.int16)
    np.put_along_axis(place, orders, np.arange(size, dtype=np.int16)[None, :], axis=1)
    behind = size - np.arange(size)  # of a pivot in one order alone
    result = np.empty((len(query), len(orders)), np.int32)
    for i, order in enumerate(query):
        theirs = place[:, order]
        here = theirs < size
        apart = np.abs(theirs - np.arange(size)).sum(1)
        shared = np.where(here, size - theirs, 0).sum(1)
        result[i] = apart + behind.sum() - shared
    return result


def best(query_ids, queries, query_orders, ids, vectors, orders, n_pivots: int, k: int, depth: int = RERANK) -> pd.DataFrame:
    """The k nearest entries of a block for each query, by exact score among the best `depth` by footrule and their ties."""
    distance = footrule(query_orders, orders, n_pivots)
    by_id = np.argsort(ids, kind="stable")
    found = []
    for i, query in enumerate(queries):
        other = by_id[ids[by_id] != query_ids[i]]
        near = other
        if len(other) > depth:
            near = other[distance[i][other] <= np.partition(distance[i][other], depth - 1)[depth - 1]]
        score = (vectors[near] * query).sum(1)
        top = np.lexsort((ids[near], -score))[:k]
        found.append(pd.DataFrame({"query_id": query_ids[i], "vec_id": ids[near][top], "score": score[top]}))
    return pd.concat(found) if found else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


def true_neighbours(index: DataFrame, sample: list, k: int) -> list:
    """`query (place in sample), vec_id, order`: the k nearest other rows of each row of `sample`, by brute force."""
    ids, asked = np.array([r.vec_id for r in sample]), np.array([r.vector for r in sample])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            own = batch.column("vec_id").to_numpy()
            scores = np.where(ids[:, None] == own[None], -np.inf, asked @ _matrix(batch.column("vector")).T)
            top = np.argsort(-scores, axis=1, kind="stable")[:, :k]
            query, row = np.repeat(np.arange(len(ids)), top.shape[1]), top.ravel()
            query, row = (x[scores[query, row] > -np.inf] for x in (query, row))
            yield pa.RecordBatch.from_arrays(
                [pa.array(query.astype(np.int32)), *(batch.column(c).take(pa.array(row)) for c in ("vec_id", "order")), pa.array(scores[query, row])],
                ["query", "vec_id", "order", "score"],
            )

    found = index.select("vec_id", "vector", "order").mapInArrow(run, "query int, vec_id long, order array<int>, score double")
    found = found.groupBy("query", "vec_id").agg(F.max(F.struct("score", "order")).alias("best"))
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("best.score"), "vec_id"))
    # at most SAMPLED times k rows
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query", "vec_id", "best.order").collect()


def measured(index: DataFrame, pivots: np.ndarray, posted: int, k: int) -> tuple[int, int]:
    """How many files to open, and how many of their entries to score, as sampled queries need it."""
    sample = index.where("is_query").orderBy(F.xxhash64("vec_id", F.lit(SEED)), "vec_id").limit(SAMPLED).collect()
    pairs = true_neighbours(index, sample, k) if sample else []
    if not pairs:
        return 1, RERANK
    n_pivots = len(pivots)
    asked = np.array([r.order for r in sample])
    place = np.argsort(nearest_pivots(np.array([r.vector for r in sample]), pivots, n_pivots), axis=1)
    query, orders = np.array([p.query for p in pairs]), np.array([p.order for p in pairs])
    reach = place[query[:, None], orders[:, :posted]]
    file, reach = orders[np.arange(len(pairs)), reach.argmin(1)], reach.min(1)
    own = np.array([footrule(asked[q][None], o[None], n_pivots)[0, 0] for q, o in zip(query, orders)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ahead = np.zeros(len(query), np.int64)
        for batch in batches:
            if not len(batch):
                continue
            theirs = _matrix(batch.column("order"))
            distance = footrule(asked, theirs, n_pivots)
            for i, (q, f) in enumerate(zip(query, file)):
                ahead[i] += (distance[q][(theirs[:, :posted] == f).any(1)] < own[i]).sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(query), dtype=np.int32)), pa.array(ahead)], ["pair", "ahead"])

    rows = index.select("order").mapInArrow(run, "pair int, ahead long").groupBy("pair").agg(F.sum("ahead").alias("ahead")).collect()
    ahead = np.zeros(len(query), np.int64)
    for row in rows:
        ahead[row.pair] = row.ahead
    probes = int(np.sort(reach)[math.ceil(REACHED * len(reach)) - 1]) + 1
    depth = int(np.sort(np.where(reach < probes, ahead, np.iinfo(np.int64).max))[math.ceil(FOUND * len(reach)) - 1]) + 1
    return probes, max(RERANK, depth)


def search(
    vectors: DataFrame, queries: Column, k: int = 20, id_column: str = "vec_id", vector_column: str = "embedding",
    probes: int | None = None,
) -> DataFrame:
    """`query_id, rank, vec_id, score`: the k nearest found of each row where `queries` holds, among all other rows."""
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("vector"),
        F.coalesce(queries, F.lit(False)).alias("is_query"),
    ).where(F.col("vec_id").isNotNull() & takes_part("vector"))
    lengths = rows.groupBy(F.size("vector").alias("length")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("length")).first()
    if lengths is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows, n = rows.where(F.size("vector") == lengths["length"]), lengths.n
    n_pivots = min(MAX_PIVOTS, max(32, math.ceil(4 * math.sqrt(n))), n)
    drawn = rows.groupBy("vector").agg(F.min("vec_id").alias("id")).orderBy(F.xxhash64("id", F.lit(SEED)), "id").limit(n_pivots)
    pivots = np.array([r.vector for r in drawn.select("vector").collect()])  # at most MAX_PIVOTS
    n_pivots = len(pivots)
    prefix, posted = min(PREFIX, n_pivots), min(POSTED, n_pivots)
    shared = spark.sparkContext.broadcast(pivots)

    def represent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            order = nearest_pivots(_matrix(batch.column("vector")), shared.value, prefix)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("vec_id", "vector", "is_query")), pa.array(list(order.astype(np.int32)), pa.list_(pa.int32()))],
                ["vec_id", "vector", "is_query", "order"],
            )

    index = stage(rows.mapInArrow(represent, "vec_id long, vector array<double>, is_query boolean, order array<int>"), "index")
    needed, depth = measured(index, pivots, posted, k)
    probes = min(n_pivots, probes or needed)

    def open_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            opened = nearest_pivots(_matrix(batch.column("vector")), shared.value, probes)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(list(opened.astype(np.int32)), pa.list_(pa.int32()))], [*batch.schema.names, "opened"]
            )

    entries = index.select("vec_id", "vector", "order", F.explode(F.slice("order", 1, posted)).alias("pivot"))
    asked = index.where("is_query").select("vec_id", "vector", "order").mapInArrow(
        open_files, "vec_id long, vector array<double>, order array<int>, opened array<int>"
    ).select("vec_id", "vector", "order", F.explode("opened").alias("pivot"))
    # two numbers for each pivot
    sizes = (
        entries.groupBy("pivot").agg(F.ceil(F.count("*") / FILE_BLOCK).cast("int").alias("blocks"))
        .join(asked.groupBy("pivot").agg(F.ceil(F.count("*") / QUERY_BLOCK).cast("int").alias("query_blocks")), "pivot")
    )
    sizes = F.broadcast(sizes)
    cell = ["pivot", "block", "query_block"]
    entries = (
        entries.join(sizes, "pivot").withColumn("block", F.pmod(F.xxhash64("vec_id"), "blocks").cast("int"))
        .withColumn("query_block", F.explode(F.sequence(F.lit(0), F.col("query_blocks") - 1)))
        .select(*cell, "vec_id", "vector", "order")
    )
    asked = (
        asked.join(sizes, "pivot").withColumn("query_block", F.pmod(F.xxhash64("vec_id"), "query_blocks").cast("int"))
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(*cell, "vec_id", "vector", "order")
    )

    def compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        return best(
            left.vec_id.to_numpy(), np.stack(left.vector.to_list()), np.stack(left.order.to_list()),
            right.vec_id.to_numpy(), np.stack(right.vector.to_list()), np.stack(right.order.to_list()), n_pivots, k, depth,
        )

    found = (
        asked.groupBy(*cell).cogroup(entries.groupBy(*cell)).applyInPandas(compare, "query_id long, vec_id long, score double")
        .groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    )
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
