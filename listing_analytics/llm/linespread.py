"""Boilerplate lines: lines on many distinct sites, found with one HyperLogLog sketch of sites per line hash.

Each task sketches the sites of the lines it reads and the sketches merge by aggregation, so a line on every page costs
one sketch per task. Estimates far from the threshold decide at once; lines near it (`BAND` standard errors) get an exact
distinct count. Of a boilerplate line the first occurrence (smallest document id, then first place) stays, all others go,
so text that a whole group of copies shares is never lost.

Defined cases: a null text stays null, an empty one stays empty. Blank lines are never boilerplate. A null site is no site.
A null id comes before all others. Rows that agree in id and text are treated alike, so both keep a first occurrence.
Lines are told apart by a 128-bit hash. DataFrame functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from listing_analytics.llm.words import free_name

MIN_SITES = 10
SKETCH_BITS = 12
#: Standard errors around the threshold within which a line's sites are counted exactly.
BAND = 6.0


def occurrences(docs: DataFrame) -> DataFrame:
    """`id, text_hash, site, place, h1, h2` for each line that is not blank."""
    return (
        docs.select(
            F.col("doc_id").alias("id"), F.xxhash64("text").alias("text_hash"), F.col("source").alias("site"),
            F.posexplode(F.split("text", "\n", -1)).alias("place", "line"),
        )
        .where(F.trim("line", F.lit(" \t\r")) != "")
        .select("id", "text_hash", "site", "place", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"))
    )


def boilerplate_lines(docs: DataFrame, min_sites: int = MIN_SITES, sketch_bits: int = SKETCH_BITS) -> DataFrame:
    """`h1, h2, first_id, first_place` of the lines on at least `min_sites` distinct sites."""
    lines = occurrences(docs)
    error = BAND * 1.04 / math.sqrt(1 << sketch_bits)
    spread = (
        lines.groupBy("h1", "h2")
        .agg(
            F.hll_sketch_estimate(F.hll_sketch_agg("site", sketch_bits)).alias("sites"),
            F.min(F.struct("id", "place")).alias("first"),
        )
        .where(F.col("sites") >= math.floor(min_sites * (1 - error)))
    )
    near = F.col("sites") <= math.ceil(min_sites * (1 + error))
    exact = (
        lines.select("h1", "h2", "site").distinct()  # before the join, so that a line has a row for each site at most
        .join(spread.where(near).select("h1", "h2"), ["h1", "h2"], "left_semi")
        .groupBy("h1", "h2").agg(F.count("site").alias("exact_sites"))
    )
    return (
        spread.join(exact, ["h1", "h2"], "left")
        .where(F.coalesce("exact_sites", "sites") >= min_sites)
        .select("h1", "h2", F.col("first.id").alias("first_id"), F.col("first.place").alias("first_place"))
    )


def remove_boilerplate(docs: DataFrame, min_sites: int = MIN_SITES, sketch_bits: int = SKETCH_BITS) -> DataFrame:
    """`docs (doc_id, text, source, ...)` with clean texts, and `n_lines`, `n_removed`.

    A document that has lost all its lines has an empty text.
    """
    found = boilerplate_lines(docs, min_sites, sketch_bits)
    gone_id, gone_hash, places = (free_name(docs, n) for n in ("gone_id", "gone_hash", "gone_places"))
    gone = (
        occurrences(docs).drop("site").join(found, ["h1", "h2"])
        .where(~(F.col("id").eqNullSafe(F.col("first_id")) & (F.col("place") == F.col("first_place"))))
        .groupBy("id", "text_hash").agg(F.collect_set("place").alias(places))
        .withColumnsRenamed({"id": gone_id, "text_hash": gone_hash})
    )
    lines = F.split("text", "\n", -1)
    removed = F.coalesce(F.array_size(places), F.lit(0))
    left = F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), places), lambda i: F.get(lines, i))
    n_lines, n_removed = free_name(docs, "n_lines"), free_name(docs, "n_removed")
    text = F.when(removed > 0, F.array_join(left, "\n")).otherwise(F.col("text")).alias("text")
    return docs.join(
        gone, F.col("doc_id").eqNullSafe(F.col(gone_id)) & (F.xxhash64("text") == F.col(gone_hash)), "left"
    ).select(
        *[text if c == "text" else docs[c] for c in docs.columns],
        F.when(F.col("text").isNull() | (F.col("text") == ""), 0).otherwise(F.size(lines)).cast("long").alias(n_lines),
        removed.cast("long").alias(n_removed),
    )
