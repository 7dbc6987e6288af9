"""Exact, repeatable samples by row or by key.

A row belongs to the sample when its seeded hash is among the n smallest. The sample has exactly
n rows, does not depend on partitioning, and choosing it moves hashes, never whole rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, Window, functions as F

from listing_analytics.operators.filters import keep_ids, require_columns
from listing_analytics.operators.ordinals import bucket_starts, hash_bucket, seeded_hash
from listing_analytics.sources.tables import quoted
from listing_analytics.staging import stage


def _last_row(hashed: DataFrame, size: float, order: list[str]) -> Row | bool:
    """The last row of the sample in hash order, or whether the sample is the whole table.

    A histogram over the leading hash digits finds the bucket in which the sample ends, and only
    the rows of that bucket are ordered. Each step returns one row.
    """
    everything = F.sum("_size").over(Window.partitionBy())
    if size >= 1:
        wanted = F.least(F.lit(int(size)).cast("bigint"), F.col("_total"))
    else:
        # half to even, as for the number of rows of a fraction elsewhere
        wanted = F.rint(F.lit(float(size)) * F.col("_total")).cast("bigint")
    last = (
        bucket_starts(hashed.select("_hash")).withColumn("_total", everything).withColumn("_wanted", wanted)
        .where(F.col("_start") < F.col("_wanted"))
        .agg(F.max_by(F.struct("_bucket", "_start", "_wanted", "_total"), "_bucket").alias("last"))
        .head()["last"]
    )
    if last is None:
        return False
    if last["_wanted"] == last["_total"]:
        return True
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy(*order))
    in_bucket = hashed.withColumn("_bucket", hash_bucket(F.col("_hash"))).where(F.col("_bucket") == last["_bucket"])
    return in_bucket.withColumn("_rank", rank).where(F.col("_rank") == last["_wanted"] - last["_start"]).head()


def sample_rows(df: DataFrame, size: float, *keys: str, seed: int = 1) -> DataFrame:
    """Exactly `size` rows (from 1 upwards; at most all), or that fraction of the rows (below 1).

    `keys` are columns that together are unique and not null. They are read twice before the
    result is returned; the result itself is a filter on `df`. `stage` a costly `df` before.
    """
    if size < 0:
        raise ValueError(f"sample size must not be negative: {size}")
    require_columns(df, *keys)
    names = [quoted(k) for k in keys]
    last = _last_row(df.select(seeded_hash(keys, seed).alias("_hash"), *names), size, ["_hash", *names])
    if last is True:
        return df
    if last is False:
        return df.where(F.lit(False))
    bound = [F.lit(last["_hash"]), *[F.lit(last[k]).cast(df.schema[k].dataType) for k in keys]]
    return df.where(F.struct(seeded_hash(keys, seed), *names) <= F.struct(*bound))


def sample_by_key(df: DataFrame, size: float, column: str, seed: int = 1) -> DataFrame:
    """All rows of a sample of the distinct values of `column`."""
    require_columns(df, column)
    # written once: the sample reads the distinct values three times
    values = stage(df.where(F.col(quoted(column)).isNotNull()).select(quoted(column)).distinct(), "keys")
    return keep_ids(df, sample_rows(values, size, column, seed=seed), column)


def sample(df: DataFrame, size: float, select_on: str, *keys: str, seed: int = 1) -> DataFrame:
    """`sample_rows` when `select_on` is "all", else `sample_by_key` on that column."""
    if select_on.lower() == "all":
        return sample_rows(df, size, *keys, seed=seed)
    return sample_by_key(df, size, select_on, seed=seed)
