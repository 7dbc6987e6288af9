"""Quality by importance resampling: hashed n-gram models of target and raw text, Gumbel top-k.

The target model counts the documents of a labelled sample that are good; the raw model counts all documents. The
n-grams are words, their first four and five bytes, and word pairs; in a run of one word the fifth and later count as a
repeat mark.
Each falls into a cell by its hash (pairs into cells of their own, as they are many) and counts once a document, so that
one long or repetitive document cannot make a word look typical. A cell's log ratio is

    log((target + alpha) / (raw * scale + alpha))

with `scale` the median of target / raw over the cells, weighted by raw: the two models agree on ordinary words. A ratio
counts as far as the labels bear it out: with d the deviance of the good among the labelled documents of the cell from
their share in all labelled ones (about the square of a standard score), the ratio is multiplied by 1 - `evidence`^2 / d, and
is zero where that or the direction disagrees. So a word of eight toxic documents and no good one counts in a small table
too, and a word that only unlabelled documents hold counts in none. A document's log weight is the sum over its distinct cells; documents are drawn without replacement, in proportion to
weight^(1 / temperature), as the k largest of log weight / temperature + Gumbel noise. The noise is a hash of the id and
the seed, so a rerun draws the same rows. k is the number of documents whose log weight reaches the cut that best
separates the labelled classes, good, bad and toxic (or a number given by the caller).

Defined cases: a null or empty text has no cells and log weight 0. Labels that are null or contradict each other on a
document are bad if any of them says so; label rows without an id, or with both flags null, are left out. No good
labelled document, or no other one: every weight is 0 and everything is kept. Rows that are equal in id and text are kept or rejected
together. A null id is an id like any other for the noise, but never labelled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from listing_analytics.llm.chunks import GROUP_CHARS, grouped
from listing_analytics.llm.words import free_name
from listing_analytics.staging import stage

WORD_CELLS, PAIR_CELLS = 1 << 20, 1 << 19
CELLS = WORD_CELLS + PAIR_CELLS
#: Labelled documents that the models are fitted on, at most (about; drawn by the hash of the id). Bounds the broadcasts.
MAX_LABELLED = 200_000
ALPHA = 0.5
#: Standard scores below which the labels of a cell's documents say nothing.
EVIDENCE = 2.5
TEMPERATURE = 0.05
SEED = 17
#: A lost share of good documents weighs as much as this many kept shares of bad, or of toxic, ones.
GOOD_COUNTS = 3.0


# kinds of bytes: white space, letters and digits (with all bytes of signs beyond ASCII), other signs
_KIND = np.array([
    0 if b in b" \t\n\r\x0b\x0c" else 1 if 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 else 2 for b in range(256)
], np.uint8)
_STEP, _MIX = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_BACK = pow(_STEP, -1, 1 << 64)


_power_tables: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """The first n + 1 powers; those of texts of ordinary length are kept."""
    found = _power_tables.get(base)
    if found is None or len(found) <= n:
        found = np.full(max(n, GROUP_CHARS + GROUP_CHARS // 4) + 1, base, np.uint64)
        found[0] = 1
        np.cumprod(found, out=found)
        if n <= GROUP_CHARS + GROUP_CHARS // 4:
            _power_tables[base] = found
    return found[:n + 1]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(_MIX)
    return (h ^ (h >> np.uint64(29))) * np.uint64(_STEP) >> np.uint64(20)


def cells_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Document numbers and the distinct cells of each document's n-grams, sorted.

    Words, in lower case: runs of letters and digits, or of other signs. A word's hash is a difference of running sums of
    its bytes times powers, so all words of the texts are hashed at once.
    """
    # a blank before each text keeps words of neighbours apart
    parts = [b" " + (t or "").lower().encode() for t in texts]
    data = np.frombuffer(b"".join(parts), np.uint8)
    kind = _KIND[data]
    change = np.flatnonzero(kind[1:] != kind[:-1]) + 1
    begins = np.flatnonzero(kind[change])
    starts = change[begins]
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    stops = np.append(change, len(data))[begins + 1]
    doc = np.searchsorted(np.cumsum([len(p) for p in parts]), starts, "right")
    with np.errstate(over="ignore"):
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_STEP, len(data))[:-1], dtype=np.uint64)))
        back = _powers(_BACK, len(data))[starts]  # powers of the inverse

        def hashed(upto: np.ndarray) -> np.ndarray:
            return (sums[upto] - sums[starts]) * back

        words = hashed(stops)
        # the fifth and later of a run of one word
        run = np.zeros(len(words), bool)
        run[4:] = (words[4:] == words[3:-1]) & (words[4:] == words[:-4]) & (doc[4:] == doc[:-4])
        words[run] = np.uint64(1)
        keys = [_mixed(words)] + [_mixed(hashed(np.minimum(stops, starts + n)) + np.uint64(n)) for n in (4, 5)]
        pairs = _mixed(_mixed(words[:-1]) * np.uint64(_STEP) + words[1:])
    together = doc[1:] == doc[:-1]
    cells = [(k & np.uint64(WORD_CELLS - 1)).astype(np.int64) for k in keys]
    pair_cells = (pairs & np.uint64(PAIR_CELLS - 1)).astype(np.int64)[together] + WORD_CELLS
    both = np.sort(np.concatenate([np.tile(doc, 3), doc[1:][together]]) << 32 | np.concatenate([*cells, pair_cells]))
    both = both[np.concatenate(([True], both[1:] != both[:-1]))]  # np.unique hashes, which takes far longer
    return both >> 32, both & 0xFFFFFFFF


def labelled_sample(labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """`id, good, toxic` for about `max_labelled` labelled documents at most, those with the smallest hashes."""
    known = (
        labels.where("doc_id IS NOT NULL AND (quality IS NOT NULL OR toxic IS NOT NULL)")
        .groupBy("doc_id")
        .agg(
            (F.min(F.coalesce("quality", F.lit(1))) * (1 - F.max(F.coalesce("toxic", F.lit(0)))) > 0).alias("good"),
            (F.max(F.coalesce("toxic", F.lit(0))) > 0).alias("toxic"),
        )
        .select(F.col("doc_id").alias("id"), "good", "toxic")
    )
    n = known.count()
    if n > max_labelled:
        share = int(max_labelled / n * (1 << 30))
        known = known.where(F.pmod(F.xxhash64("id", F.lit(SEED)), F.lit(1 << 30)) < share)
    return known


def log_ratios(docs: DataFrame, known: DataFrame, alpha: float = ALPHA, evidence: float = EVIDENCE) -> np.ndarray:
    """The log ratio of every cell; `CELLS` numbers, whatever the corpus."""
    total = known.agg(F.sum(F.col("good").cast("int")).alias("good"), F.count("*").alias("n")).first()
    if not total.n or not 0 < total.good < total.n:
        return np.zeros(CELLS)
    good_share = total.good / total.n

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target, known = (np.zeros(CELLS, np.int64) for _ in range(3))
        waiting: list[tuple[np.ndarray, np.ndarray]] = []

        def add() -> None:
            cell, label = (np.concatenate(x) for x in zip(*waiting))
            raw[:] += np.bincount(cell, minlength=CELLS)
            target[:] += np.bincount(cell[label == 2], minlength=CELLS)
            known[:] += np.bincount(cell[label > 0], minlength=CELLS)
            waiting.clear()

        for batch in batches:
            labels = iter(batch.column("label").to_numpy())
            for group in grouped(t.as_py() for t in batch.column("text")):
                label = np.array([next(labels) for _ in group], np.int8)
                doc, cell = cells_of(group)
                waiting.append((cell.astype(np.int32), label[doc]))
                if sum(len(x[0]) for x in waiting) > CELLS:
                    add()
        if waiting:
            add()
        found = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (found.astype(np.int32), raw[found], target[found], known[found])], ["cell", "raw", "target", "known"]
        )

    counts = stage(
        docs.select("doc_id", "text")
        .join(F.broadcast(known.select("id", "good")), F.col("doc_id") == F.col("id"), "left")
        .select("text", F.when(F.col("good"), 2).when(~F.col("good"), 1).otherwise(0).cast("byte").alias("label"))
        .mapInArrow(count, "cell int, raw long, target long, known long")
        .groupBy("cell").agg(*(F.sum(c).alias(c) for c in ("raw", "target", "known"))),
        "cells",
    )
    share = (
        counts.withColumn("share", F.round(F.col("target") / F.col("raw"), 4)).groupBy("share")
        .agg(F.sum("raw").alias("weight"), F.sum("target").alias("t")).orderBy("share").collect()
    )  # at most 10,001 rows
    half, seen, scale = sum(r.weight for r in share) / 2, 0, 0.0
    for row in share:
        seen += row.weight
        if seen >= half:
            scale = row.share
            break
    if scale == 0 and any(r.t for r in share):  # so few good documents that most cells have none
        scale = sum(r.t for r in share) / sum(r.weight for r in share)
    def gain(n: Column, share: float) -> Column:
        return F.when(n > 0, n * F.log(n / (F.col("known") * share))).otherwise(0.0)

    deviance = 2 * (gain(F.col("target"), good_share) + gain(F.col("known") - F.col("target"), 1 - good_share))
    ratio = F.log((F.col("target") + alpha) / (F.col("raw") * F.lit(scale) + alpha))
    agree = (ratio >= 0) == (F.col("target") >= F.col("known") * good_share)
    ratio = ratio * (1 - evidence ** 2 / deviance)
    ratios = np.zeros(CELLS)
    if scale > 0:
        for row in counts.where((deviance > evidence ** 2) & agree).select("cell", ratio.alias("ratio")).toLocalIterator():
            ratios[row.cell] = row.ratio
    return ratios


def gumbel(key: Column, seed: int = SEED) -> Column:
    """Standard Gumbel noise from a hash of `key`."""
    uniform = (F.shiftrightunsigned(F.xxhash64(key, F.lit(seed)), 11).cast("double") + 0.5) / F.lit(float(1 << 53))
    return -F.log(-F.log(uniform))


def kth_largest(df: DataFrame, column: str, k: int, bins: int = 4096) -> float | None:
    """The k-th largest value of a column without nulls; histograms narrow it down, no rows are collected."""
    bounds = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi"), F.count("*").alias("n")).first()
    if not bounds.n or k < 1:
        return None
    lo, hi, above = bounds.lo, bounds.hi, 0
    k = min(k, bounds.n)
    while True:
        inside = df.where(F.col(column).between(lo, hi))
        width = (hi - lo) / bins
        if width <= 0 or lo + width == lo:
            return hi
        found = (
            inside.groupBy(F.least(F.floor((F.col(column) - lo) / width), F.lit(bins - 1)).alias("bin"))
            .agg(F.count("*").alias("n"), F.min(column).alias("lo"), F.max(column).alias("hi"))
            .orderBy(F.desc("bin")).collect()
        )  # at most `bins` rows
        for row in found:
            if above + row.n >= k:
                break
            above += row.n
        if row.n == 1 or row.lo == row.hi or above + row.n == k:
            return row.lo
        lo, hi = row.lo, row.hi


def best_cut(scored: DataFrame, known: DataFrame, steps: int = 4) -> float | None:
    """The log weight that best separates good from bad labelled documents, None without labels of both kinds.

    Best: the largest sum of the share of good documents at or above, times `GOOD_COUNTS`, and the shares of toxic ones and
    of other bad ones below; of equal cuts the one in the middle.
    """
    bins = (
        scored.join(known, scored["doc_id"] == known["id"])
        .groupBy(F.greatest(F.floor(F.col("log_weight") * steps), F.lit(-4000)).alias("bin"))
        .agg(
            F.sum(F.col("good").cast("int")).alias("good"), F.sum(F.col("toxic").cast("int")).alias("toxic"),
            F.sum((~F.col("good") & ~F.col("toxic")).cast("int")).alias("bad"),
        )
        .orderBy("bin").collect()
    )  # weights of -1000 and less share a bin
    n_good, n_toxic, n_bad = (sum(r[c] for r in bins) for c in ("good", "toxic", "bad"))
    if not n_good or not n_toxic + n_bad:
        return None
    best, cuts, good_below, toxic_below, bad_below = -1.0, (0.0, 0.0), 0, 0, 0
    for before, row in zip([None, *bins], bins):
        quality = GOOD_COUNTS * (n_good - good_below) / n_good + toxic_below / max(n_toxic, 1) + bad_below / max(n_bad, 1)
        if quality > best:
            best = quality
            cuts = ((before.bin + 1) / steps if before else row.bin / steps, row.bin / steps)
        good_below, toxic_below, bad_below = good_below + row.good, toxic_below + row.toxic, bad_below + row.bad
    return sum(cuts) / 2


def resample(
    docs: DataFrame, labels: DataFrame, columns: list[str] | None = None, k: int | None = None,
    temperature: float = TEMPERATURE, alpha: float = ALPHA, evidence: float = EVIDENCE,
    max_labelled: int = MAX_LABELLED, seed: int = SEED,
) -> DataFrame:
    """The drawn rows of `docs (doc_id, text, ...)`, with `columns` of them (all by default), `log_weight`, `sample_key`.

    `labels (doc_id, quality, toxic)`: good is quality 1 and toxic 0. Texts are read twice, counted and scored whole.
    """
    known = stage(labelled_sample(labels, max_labelled), "labelled")
    table = docs.sparkSession.sparkContext.broadcast(log_ratios(docs, known, alpha, evidence))

    keep = list(docs.columns if columns is None else columns)
    weight, key = free_name(docs, "log_weight"), free_name(docs, "sample_key")

    @F.pandas_udf("double")
    def log_weight(texts: pd.Series) -> pd.Series:
        found = []
        for group in grouped(texts):
            doc, cell = cells_of(group)
            found.append(np.bincount(doc, table.value[cell], len(group)))
        return pd.Series(np.concatenate(found) if found else [], dtype=float)

    scored = docs.withColumn(weight, log_weight("text"))
    scored = scored.withColumn(key, F.col(weight) / temperature + gumbel(F.col("doc_id").cast("string"), seed))
    scored = stage(scored.select(*dict.fromkeys([*keep, "doc_id", weight, key])), "scored")
    if k is None:
        cut = best_cut(scored.select("doc_id", F.col(weight).alias("log_weight")), known)
        k = scored.count() if cut is None else scored.where(F.col(weight) >= cut).count()
    bound = kth_largest(scored.select(key), key, k)
    drawn = scored.where(F.col(key) >= bound) if bound is not None else scored.limit(0)
    return drawn.select(*keep, weight, key)
