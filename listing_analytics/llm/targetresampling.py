"""Resampling of documents towards a target distribution of hashed word n-grams, with Arrow kernels.

Texts are lower-cased (`ascii_lower`, A-Z only), split at what is no word sign (`split_pattern_regex`), laid end to end
(`list_flatten`) and coded (`dictionary_encode`). Codes beside the codes shifted by one word are pairs; their distinct pairs,
again beside the next word, are the runs of three words, and so on. Each distinct pair is hashed once: CRC-32 of "ab" follows from
that of "a", that of "b" and the length of "b", so a run's hash comes from the shorter run's and the last word's without
building its text. `take` carries what a distinct run is worth to where it stands, and segment sums give it to the documents.

One pass counts the buckets of the documents and one those of the target; what leaves a task is at most one row for each
bucket. The gains of the buckets, the logarithm of how much more frequent they are in the target, are a fixed number of
integers and go to the workers with the second pass, which sums them up by document. A document's score adds Gumbel noise
from a hash of its id, so the highest scores are a draw without replacement by weight, the same however rows are
partitioned. Ranks come from a range shuffle of narrow rows (id, counts, score); texts are never shuffled.

Defined cases: a null text, or one without words, has no feature and weight 0. A null id is hashed as empty text. Documents
of fewer than `min_words` words are scored but never drawn. Ties of scores go to the smaller id, a null id first; rows equal
in score and id are ranked in any order, each with its own rank. An empty target gives gains that only compare
frequencies with none; an empty table of documents gives no rows.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from listing_analytics.llm.words import byte_groups, free_name
from listing_analytics.operators.ordinals import with_ordinal
from listing_analytics.staging import stage

NGRAM = 3
BUCKETS = 10_000
PERCENT = 5
MIN_WORDS = 20
SEED = 42
GROUP_BYTES = 1 << 20
#: Shift tables that a worker keeps, 4 KB for each length of a word.
MAX_TABLES = 1024
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_tables: dict[int, np.ndarray] = {}


def shift_table(length: int) -> np.ndarray:
    """For each byte of a CRC-32, what `length` further bytes make of it: four rows of 256, to be joined by exclusive or."""
    if length not in _tables:
        zeros = bytes(length)
        none = zlib.crc32(zeros)
        bits = np.array([zlib.crc32(zeros, 1 << b) ^ none for b in range(32)], np.uint32)
        byte = np.arange(256)
        table = np.zeros((4, 256), np.uint32)
        for row in range(4):
            for b in range(8):
                table[row] ^= np.where(byte >> b & 1, bits[8 * row + b], 0).astype(np.uint32)
        if len(_tables) >= MAX_TABLES:
            _tables.clear()
        _tables[length] = table
    return _tables[length]


def shifted(crc: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The part of a text's CRC-32 that its beginning, of CRC-32 `crc`, has before an end of `lengths` bytes."""
    kinds, kind = np.unique(lengths, return_inverse=True)
    result = np.empty(len(crc), np.uint32)
    step = MAX_TABLES // 2
    for lo in range(0, len(kinds), step):
        table = np.array([shift_table(n) for n in kinds[lo:lo + step].tolist()])
        at = slice(None) if len(kinds) <= step else np.flatnonzero((kind >= lo) & (kind < lo + step))
        k, c = kind[at] - lo, crc[at]
        result[at] = table[k, 0, c & 255] ^ table[k, 1, c >> 8 & 255] ^ table[k, 2, c >> 16 & 255] ^ table[k, 3, c >> 24]
    return result


class Runs:
    """The words of a group of texts, and their runs by length: where each begins, its code, and the codes' CRC-32."""

    def __init__(self, texts: pa.Array):
        lower = pc.ascii_lower(pc.fill_null(texts, "")).cast(pa.large_string())  # a cast slice would be lower-cased wrongly
        split = pc.split_pattern_regex(lower, pattern=NO_WORD)
        words = pc.list_flatten(split)
        is_word = pc.not_equal(words, "")
        before = np.append(0, np.cumsum(is_word.to_numpy(zero_copy_only=False), dtype=np.int64))
        offsets = split.offsets.to_numpy()
        self.starts = before[offsets - offsets[0]]  # of each text's words; the last is their number
        self.n_words = np.diff(self.starts)
        coded = words.filter(is_word).dictionary_encode()
        self.codes = coded.indices.to_numpy().astype(np.int64)
        self.words = coded.dictionary.cast(pa.large_binary()).to_numpy(zero_copy_only=False).tolist()
        self.left = np.repeat(self.starts[1:], self.n_words) - np.arange(len(self.codes))  # words from here to the text's end

    def __call__(self, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For runs of 1, 2, ... words: the places where they begin, their codes, and the CRC-32 of each code."""
        n = len(self.words)
        at, codes = np.arange(len(self.codes)), self.codes
        crc = np.array(list(map(zlib.crc32, self.words)), np.uint32)
        yield at, codes, crc
        tails = np.array([zlib.crc32(b" " + w) for w in self.words], np.uint32)
        lengths = np.array(list(map(len, self.words)), np.int64) + 1
        for size in range(2, longest + 1):
            more = self.left[at] >= size
            at, codes = at[more], codes[more]
            pairs = pa.array(codes * n + self.codes[at + size - 1]).dictionary_encode()
            head, tail = np.divmod(pairs.dictionary.to_numpy(), max(n, 1))
            codes, crc = pairs.indices.to_numpy().astype(np.int64), shifted(crc[head], lengths[tail]) ^ tails[tail]
            yield at, codes, crc


def bucket_counts(texts: DataFrame, column: str = "text", longest: int = NGRAM, buckets: int = BUCKETS) -> DataFrame:
    """`bucket, n`: runs of one to `longest` words of all texts by bucket, repeats counted; empty buckets have no row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in byte_groups(batch, "text", GROUP_BYTES):
                for _, codes, crc in Runs(part.column("text"))(longest):
                    total += np.bincount((crc % np.uint32(buckets))[codes], minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], ["bucket", "n"])

    counts = texts.select(F.col(column).cast("string").alias("text")).mapInArrow(run, "bucket int, n long")
    return counts.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, column: str, target_column: str, longest: int, buckets: int) -> np.ndarray:
    """A thousand times the log ratio of each bucket's share in the target to that in the documents, add-one, rounded down."""

    def gathered(df: DataFrame, name: str) -> np.ndarray:
        counts = np.zeros(buckets, object)
        for row in bucket_counts(df, name, longest, buckets).collect():  # one row a bucket at most
            counts[row.bucket] = row.n
        return counts

    own, wanted = gathered(docs, column), gathered(target, target_column)
    n_own, n_wanted = sum(own.tolist()), sum(wanted.tolist())
    return np.array([
        math.floor(1000 * math.log(float((t + 1) * (n_own + buckets)) / float((s + 1) * (n_wanted + buckets))))
        for s, t in zip(own.tolist(), wanted.tolist())
    ], np.int64)


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Standard Gumbel noise in thousandths, rounded down, from a hash of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    uniform = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long").cast("double") + 0.5) / 4294967296.0
    return F.floor(F.lit(-1000.0) * F.log(-F.log(uniform)))


def scored(
    docs: DataFrame, target: DataFrame, column: str = "text", target_column: str = "text", doc_id: str = "doc_id",
    longest: int = NGRAM, buckets: int = BUCKETS, seed: int = SEED,
) -> DataFrame:
    """`row` (a struct of all columns of `docs`), `doc_id`, `n_words`, `n_features`, `weight`, `score` of every document."""
    gains = bucket_gains(docs, target, column, target_column, longest, buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_groups(batch, "text", GROUP_BYTES):
                runs = Runs(part.column("text"))
                worth = np.zeros(len(runs.codes) + 1, np.int64)  # of all runs that begin at a word
                for at, codes, crc in runs(longest):
                    worth[at] += gains[crc % np.uint32(buckets)].take(codes)
                weight = np.where(runs.n_words > 0, np.add.reduceat(worth, runs.starts[:-1]), 0)
                sizes = np.arange(longest)
                features = np.maximum(runs.n_words[:, None] - sizes, 0).sum(1)
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), part.column("doc_id"), pa.array(runs.n_words), pa.array(features), pa.array(weight)],
                    ["row", "doc_id", "n_words", "n_features", "weight"],
                )

    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
        F.col(f"`{column}`").cast("string").alias("text"),
    )
    out = StructType([rows.schema["row"]])
    for name in ("doc_id", "n_words", "n_features", "weight"):
        out = out.add(name, "long")
    return rows.mapInArrow(run, out).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))


def ranked(scores: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """`scores (doc_id, n_words, n_features, weight, score)` with `rank`: 1, 2, ... of the drawn, null of the others."""
    narrow = scores.select("doc_id", "n_words", "n_features", "weight", "score", (-F.col("score")).alias("_down"))
    table = stage(narrow, "scores").withColumn("_tie", F.monotonically_increasing_id())
    long_enough = F.col("n_words") >= min_words
    placed = with_ordinal(table.where(long_enough), "_down", "doc_id", "_tie", name="_place", total="_total")
    rank = F.when(F.col("_place") < F.floor(F.lit(percent) * F.col("_total") / 100), F.col("_place") + 1).cast("long")
    placed = placed.withColumn("rank", rank).drop("_place", "_total")
    rest = table.where(~long_enough).withColumn("rank", F.lit(None).cast("long"))
    return placed.unionByName(rest).drop("_down", "_tie")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, **options) -> DataFrame:
    """The drawn rows of `docs`, all their columns, with their score added (`score`, or with underscores before it).

    Only the score and id of the last drawn document come to the driver; the rows behind them are filtered, not shuffled.
    Rows that equal it in both are all kept.
    """
    table = stage(scored(docs, target, **options), "scored")
    last = ranked(table, percent, min_words).where(F.col("rank").isNotNull()).orderBy(F.desc("rank")).limit(1).collect()
    name = free_name(docs, "score")
    if not last:
        return table.limit(0).select("row.*", F.col("score").alias(name))
    score, doc_id = last[0].score, last[0].doc_id
    behind = F.col("doc_id").isNull() if doc_id is None else F.col("doc_id").isNull() | (F.col("doc_id") <= doc_id)
    drawn = (F.col("n_words") >= min_words) & ((F.col("score") > score) | ((F.col("score") == score) & behind))
    return table.where(drawn).select("row.*", F.col("score").alias(name))
