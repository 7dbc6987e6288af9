"""A training corpus from `documents` in five stages; each works on what the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from listing_analytics.llm import bpe, decontamination, linespread, resampling, simhash
from listing_analytics.staging import stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling against the labelled good ones draws."""
    return resampling.resample(docs, _table(spark, sf_dir, "labels")).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without boilerplate lines; `n_chars` follows the text. No document goes."""
    clean = linespread.remove_boilerplate(docs)
    if "n_chars" in docs.columns:
        kind, n_removed = docs.schema["n_chars"].dataType, F.col(clean.columns[-1])  # under a name that is free in docs
        clean = clean.withColumn("n_chars", F.when(n_removed > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return clean.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash.deduplicate(docs).select(*docs.columns)


def contamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return decontamination.decontaminate(docs, _table(spark, sf_dir, "benchmark")).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded texts."""
    return bpe.round_trip(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", contamination),
    ("byte-level BPE", tokens),
]

#: Hashed models, XXH64 fingerprints and BPE have no SQL form; tests compare the stages with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each result written as Parquet and read again."""
    docs = _table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
