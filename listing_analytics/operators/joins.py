"""Many-to-one joins of facts (reviews, photos) to a table with one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from listing_analytics.operators.filters import join_on, require_columns
from listing_analytics.operators.ordinals import with_ordinal
from listing_analytics.sources.tables import quoted

MANY_TO_ONE = ("inner", "left", "left_semi", "left_anti")


def attach(facts: DataFrame, lookup: DataFrame, key: str, how: str = "left", salts: int = 1) -> DataFrame:
    """Join `facts` to `lookup`, which has one row per `key`.

    Spark broadcasts `lookup` when its size allows; else both sides are shuffled on the key and
    adaptive execution splits hot partitions of `facts`. Where a hot key is known beforehand (or
    adaptive execution is off), `salts` spreads every key over that many partitions by a hash of
    the fact row, against as many copies of `lookup`.
    """
    if how not in MANY_TO_ONE:
        raise ValueError(f"join type {how!r} not known; expected one of {MANY_TO_ONE}")
    require_columns(facts, key)
    require_columns(lookup, key)
    if salts <= 1:
        return join_on(facts, lookup, key, how)
    salt = F.pmod(F.xxhash64(*[F.col(quoted(c)) for c in facts.columns]), F.lit(salts))
    every_salt = F.array(*[F.lit(i).cast("bigint") for i in range(salts)])
    copies = lookup.withColumn("_salt", F.explode(every_salt))
    return join_on(facts.withColumn("_salt", salt), copies, [key, "_salt"], how).drop("_salt")


def hot_keys(df: DataFrame, key: str, share: float) -> list[tuple]:
    """`(key, rows)` of every key that more than `share` of the rows have, fewer than `1 / share` of them, and the rows without key.

    One pass keeps a sketch of frequent items, which misses no such key; a second one counts only what it names.
    """
    column = F.col(quoted(key))
    named = df.where(column.isNotNull()).select(column.alias("key"))
    found = named.stat.freqItems(["key"], max(share, 1e-4)).head()[0] or []
    total, *counts = df.agg(F.count(F.lit(1)), *[F.count_if(column == F.lit(k)) for k in found]).head()
    return [(k, n) for k, n in zip(found, counts) if n > share * total]


def attach_hot(
    facts: DataFrame, lookup: DataFrame, key: str, salt_by: str | Sequence[str], how: str = "left", partitions: int | None = None
) -> DataFrame:
    """`attach` for facts with hot keys, also without adaptive execution.

    Keys that more than half of an average partition's rows have are found by `hot_keys`. Only their rows are spread, each key over
    as many salts as make pieces of a quarter of an average partition, by a hash of the columns `salt_by`, in which
    rows of one key differ; rows without a key, which match nothing, are spread as well. Other keys join as they are.
    """
    if how not in MANY_TO_ONE:
        raise ValueError(f"join type {how!r} not known; expected one of {MANY_TO_ONE}")
    names = [salt_by] if isinstance(salt_by, str) else list(salt_by)
    require_columns(facts, key, *names)
    require_columns(lookup, key)
    spark = facts.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot = hot_keys(facts, key, 1 / (2 * partitions))
    total = facts.count() if hot else 1
    kind = facts.schema[key].dataType
    # at most two keys for each partition
    salts = spark.createDataFrame(
        [(k, -(-4 * n * partitions // total)) for k, n in hot], T.StructType([T.StructField(key, kind), T.StructField("_salts", T.LongType())])
    )
    spread = F.pmod(F.xxhash64(*[F.col(quoted(c)) for c in names]), F.coalesce("_salts", F.when(F.col(quoted(key)).isNull(), 4 * partitions), F.lit(1)))
    salted = join_on(facts, F.broadcast(salts), key, "left").withColumn("_salt", spread.cast("long")).drop("_salts")
    copies = join_on(lookup, F.broadcast(salts), key, "left")
    last = (F.coalesce("_salts", F.lit(1)) - 1).cast("long")
    copies = copies.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), last))).drop("_salts")
    return join_on(salted, copies, [key, "_salt"], how).drop("_salt")


def attach_outer(facts: DataFrame, lookup: DataFrame, key: str, match_nulls: bool = False) -> DataFrame:
    """Full outer join of facts to a table with one row per key.

    A full outer join keeps all rows of a key in one task. This is its equal: the left join, which
    can be split, and the lookup rows whose key no fact has, found from the distinct fact keys.
    `match_nulls` lets a missing key match a missing key.
    """
    require_columns(facts, key)
    require_columns(lookup, key)
    column = quoted(key)

    def same(left: str, right: str) -> Column:
        pair = F.col(f"{left}.{column}"), F.col(f"{right}.{column}")
        return pair[0].eqNullSafe(pair[1]) if match_nulls else pair[0] == pair[1]

    looked_up = [F.col(f"l.{quoted(c)}") for c in lookup.columns if c != key]
    matched = facts.alias("f").join(lookup.alias("l"), same("f", "l"), "left").select("f.*", *looked_up)
    keys = facts.select(column).distinct()
    unmatched = lookup.alias("l").join(keys.alias("k"), same("l", "k"), "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)


def align(truth: DataFrame, predicted: DataFrame, key: str, unmatched: str = "error") -> DataFrame:
    """Truth and prediction of each row; `key` is unique in both tables.

    A row that only one table has raises an error when it is read (`unmatched="error"`), or is left out
    (`"skip"`); `misaligned` lists them.
    """
    if unmatched not in ("error", "skip"):
        raise ValueError(f"unmatched must be 'error' or 'skip': {unmatched!r}")
    if unmatched == "skip":
        return truth.join(predicted, key, "inner")
    both = truth.withColumn("_truth", F.lit(True)).join(predicted.withColumn("_predicted", F.lit(True)), key, "full_outer")
    alone = F.concat(F.lit("row in one table only: "), F.coalesce(F.col(quoted(key)).cast("string"), F.lit("null")))
    paired = F.col("_truth") & F.col("_predicted")
    return both.where(F.when(paired, True).otherwise(F.raise_error(alone).cast("boolean"))).drop("_truth", "_predicted")


def align_positions(
    truth: DataFrame, predicted: DataFrame, key: str, order: Sequence[str], predicted_order: Sequence[str]
) -> DataFrame:
    """Truth and prediction of the rows at the same position, each table in its own order of unique columns.

    Positions come from range partitions and their sizes. A position at which the tables have different values of `key`,
    or that only one of them has, raises an error when it is read. Columns of both tables but `key` come from `truth`.
    """
    require_columns(truth, key, *order)
    require_columns(predicted, key, *predicted_order)
    left = with_ordinal(truth, *order, name="_position").withColumn("_truth", F.lit(True))
    named = [F.col(quoted(c)) for c in predicted.columns if c == key or c in predicted_order or c not in truth.columns]
    right = with_ordinal(predicted.select(*named), *predicted_order, name="_position")
    extra = [c for c in right.columns if c not in truth.columns and c != "_position"]
    right = right.select("_position", F.col(quoted(key)).alias("_key"), F.lit(True).alias("_predicted"), *[quoted(c) for c in extra])
    both = left.join(right, "_position", "full_outer")
    fits = F.col("_truth") & F.col("_predicted") & F.col(quoted(key)).eqNullSafe(F.col("_key"))
    shown = [F.coalesce(F.col(c).cast("string"), F.lit("nothing")) for c in ("_position", quoted(key), "_key")]
    wrong = F.concat(F.lit("unexpected row at position "), shown[0], F.lit(": truth "), shown[1], F.lit(", prediction "), shown[2])
    aligned = both.where(F.when(fits, True).otherwise(F.raise_error(wrong).cast("boolean")))
    return aligned.select(*[quoted(c) for c in truth.columns + extra])


def misaligned(truth: DataFrame, predicted: DataFrame, key: str) -> DataFrame:
    """Keys that only one of the tables has, with the table that has them."""
    left = truth.join(predicted, key, "left_anti").select(quoted(key), F.lit("truth").alias("only_in"))
    right = predicted.join(truth, key, "left_anti").select(quoted(key), F.lit("predicted").alias("only_in"))
    return left.unionByName(right)


def match_files(photos: DataFrame, files: DataFrame, extensions: list[str], unmatched: str = "error") -> DataFrame:
    """The first file of each photo, extensions in the order given, then by `photo_file`.

    `files` has `stem, ext, photo_file` and any other columns; a photo's file is the one whose stem
    is its `photo_id`. A photo without file raises an error when the row is read
    (`unmatched="error"`), or is left out (`"skip"`).
    """
    if unmatched not in ("error", "skip"):
        raise ValueError(f"unmatched must be 'error' or 'skip': {unmatched!r}")
    order = F.array_position(F.array(*[F.lit(e) for e in extensions]), F.col("ext"))
    others = [F.col(quoted(c)) for c in files.columns if c not in ("stem", "ext")]
    first = (
        files.withColumn("_order", order)
        .where(F.col("_order") > 0)
        .groupBy(F.col("stem").alias("photo_id"))
        .agg(F.min_by(F.struct(*others), F.struct("_order", "photo_file")).alias("_file"))
    )
    joined = photos.join(first, "photo_id", "inner" if unmatched == "skip" else "left")
    if unmatched == "error":
        missing = F.raise_error(F.concat(F.lit("no file for photo "), F.col("photo_id").cast("string")))
        joined = joined.withColumn("_file", F.when(F.col("_file").isNull(), missing).otherwise(F.col("_file")))
    return joined.select(*[quoted(c) for c in photos.columns], "_file.*")
