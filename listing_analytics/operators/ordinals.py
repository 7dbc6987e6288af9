"""Row positions in a global order, without one task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from listing_analytics.sources.tables import quoted
from listing_analytics.staging import stage

# `monotonically_increasing_id` holds the partition above this bit and the row within it below.
ROW_BITS = 33

# Leading hex digits of a hash that name its bucket, unless the number of rows says otherwise.
BUCKET_DIGITS = 4

# Rows of a bucket, about, where the number of buckets follows the number of rows.
BUCKET_ROWS = 1 << 16


def with_ordinal(df: DataFrame, *keys: str, name: str = "ordinal", total: str | None = None) -> DataFrame:
    """Add the zero-based position of each row in the order of the unique columns `keys`.

    Rows are range-partitioned and sorted once and written with their partition and place;
    the positions are then the places plus the sizes of the partitions before. The written
    table fixes the sampled range bounds: a recomputed plan could draw others. Select the
    columns needed before, because all columns of `df` are written. `total` names a column for
    the number of rows.
    """
    columns = [F.col(quoted(k)) for k in keys]
    ranged = df.repartitionByRange(*columns).sortWithinPartitions(*columns)
    placed = stage(ranged.withColumn("_place", F.monotonically_increasing_id()), "ordinal")
    part = F.shiftright("_place", ROW_BITS)
    # one row per partition of the range shuffle, so the windows and the broadcast stay small
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_part",
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"),
        F.sum("_size").over(Window.partitionBy()).alias("_total"),
    )
    within = F.col("_place").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    positioned = (
        placed.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + within)
    )
    kept = [quoted(c) for c in df.columns] + [quoted(name)]
    return positioned.select(*kept, *([F.col("_total").alias(total)] if total else []))


def seeded_hash(keys: tuple[str, ...], seed: int) -> Column:
    """A uniform hash of the key columns and a seed, equal on every engine that has MD5."""
    return F.md5(F.concat_ws("|", *[F.col(quoted(k)).cast("string") for k in keys], F.lit(str(seed))))


def bucket_digits(rows: int) -> int:
    """Hex digits that give buckets of `BUCKET_ROWS` at most, or a sixteenth of it at least."""
    return next(d for d in range(1, 16) if rows <= BUCKET_ROWS * 16 ** d)


def hash_bucket(digest: Column, digits: int = BUCKET_DIGITS) -> Column:
    return F.left(digest, F.lit(digits))


def bucket_starts(digests: DataFrame, digits: int = BUCKET_DIGITS) -> DataFrame:
    """`_bucket, _size, _start`: rows per bucket of `_hash` and in the buckets before it.

    The window runs in one task over one row per bucket, whatever the input size.
    """
    sizes = digests.groupBy(hash_bucket(F.col("_hash"), digits).alias("_bucket")).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.withColumn("_start", F.coalesce(F.sum("_size").over(before), F.lit(0)))


def with_shuffled_ordinal(df: DataFrame, *keys: str, seed: int = 1, name: str = "ordinal") -> DataFrame:
    """Add the zero-based position of each row in a seeded random order of the unique `keys`.

    The bucket of a row depends on its key alone, so nothing has to be written: positions are
    counted inside small, equal buckets and the sizes of the buckets before are added. The rows are counted
    first, which sets the number of buckets.
    """
    digits = bucket_digits(df.count())
    hashed = df.withColumn("_hash", seeded_hash(keys, seed)).withColumn("_bucket", hash_bucket(F.col("_hash"), digits))
    starts = bucket_starts(hashed.select("_hash"), digits).select("_bucket", "_start")
    order = Window.partitionBy("_bucket").orderBy("_hash", *[F.col(quoted(k)) for k in keys])
    return (
        hashed.withColumn("_within", F.row_number().over(order))
        .join(starts, "_bucket")
        .withColumn(name, F.col("_start") + F.col("_within") - 1)
        .drop("_hash", "_bucket", "_within", "_start")
    )
