"""Samples, splits and batches."""

from pyspark.sql import functions as F

from listing_analytics.operators import ordinals, profile, sampling, splits
from listing_analytics.registry import base
from listing_analytics.registry.base import query

ORDER_HASH = "md5(CAST(o_orderkey AS VARCHAR) || '|1')"


def orders(spark, sf):
    return base.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")


@query("sample_n_rows", f"""
    SELECT o_orderkey, o_custkey, o_orderstatus FROM orders ORDER BY {ORDER_HASH}, o_orderkey LIMIT 700""")
def sample_n_rows(spark, sf):
    return sampling.sample_rows(orders(spark, sf), 700, "o_orderkey")


@query("sample_fraction_rows", f"""
    SELECT o_orderkey, o_custkey, o_orderstatus FROM (
        SELECT *, row_number() OVER (ORDER BY {ORDER_HASH}, o_orderkey) AS r, count(*) OVER () AS n FROM orders)
    WHERE r <= CAST(round_even(0.2 * n, 0) AS BIGINT)""")
def sample_fraction_rows(spark, sf):
    return sampling.sample_rows(orders(spark, sf), 0.2, "o_orderkey")


@query("sample_by_key", """
    WITH k AS (SELECT o_custkey, row_number() OVER (ORDER BY md5(CAST(o_custkey AS VARCHAR) || '|1'), o_custkey) AS r
               FROM (SELECT DISTINCT o_custkey FROM orders))
    SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
    WHERE o_custkey IN (SELECT o_custkey FROM k WHERE r <= 100)""")
def sample_by_key(spark, sf):
    return sampling.sample(orders(spark, sf), 100, "o_custkey")


@query("seeded_shuffle", """
    SELECT o_orderkey, row_number() OVER (ORDER BY md5(CAST(o_orderkey AS VARCHAR) || '|7'), o_orderkey) - 1 AS ordinal
    FROM orders""")
def seeded_shuffle(spark, sf):
    return ordinals.with_shuffled_ordinal(orders(spark, sf).select("o_orderkey"), "o_orderkey", seed=7)


@query("row_ordinals", """
    SELECT o_custkey, o_orderkey, row_number() OVER (ORDER BY o_custkey, o_orderkey) - 1 AS ordinal FROM orders""")
def row_ordinals(spark, sf):
    return ordinals.with_ordinal(orders(spark, sf).select("o_custkey", "o_orderkey"), "o_custkey", "o_orderkey")


def placed(spark, sf):
    return ordinals.with_ordinal(
        orders(spark, sf).select("o_orderkey", "o_orderstatus"), "o_orderkey", total="rows_in_all"
    )


PLACED = """
    SELECT o_orderkey, o_orderstatus, row_number() OVER (ORDER BY o_orderkey) - 1 AS ordinal,
           CAST(count(*) OVER () AS DOUBLE) AS n
    FROM orders"""

REST = f"SELECT *, floor(n - n * 0.05::DOUBLE) AS rest FROM ({PLACED}) AS p"


@query("split_holdout", f"SELECT o_orderkey, ordinal FROM ({REST}) AS r WHERE ordinal >= rest")
def split_holdout(spark, sf):
    return splits.holdout_rows(placed(spark, sf), 0.05, total="rows_in_all").select("o_orderkey", "ordinal")


THREE_WAY = f"""
    SELECT o_orderkey, o_orderstatus, ordinal, CASE WHEN ordinal >= rest THEN 'verify'
        WHEN ordinal >= floor(rest - rest * 0.2::DOUBLE) THEN 'validation' ELSE 'train' END AS split
    FROM ({REST}) AS r"""


@query("split_three_way", f"SELECT o_orderkey, split FROM ({THREE_WAY}) AS t")
def split_three_way(spark, sf):
    return splits.split_rows(placed(spark, sf), splits.Split(0.05, 0.2), total="rows_in_all").select("o_orderkey", "split")


@query("split_head_validation", f"""
    SELECT o_orderkey, CASE WHEN ordinal >= rest THEN 'verify'
        WHEN ordinal < floor(rest * 0.2::DOUBLE) THEN 'validation' ELSE 'train' END AS split
    FROM ({REST}) AS r""")
def split_head_validation(spark, sf):
    split = splits.Split(0.05, 0.2, validation_from="head")
    return splits.split_rows(placed(spark, sf), split, total="rows_in_all").select("o_orderkey", "split")


@query("batch_plan", f"SELECT o_orderkey, ordinal // 32 AS batch FROM ({PLACED}) AS p")
def batch_plan(spark, sf):
    return splits.batch_index(placed(spark, sf), 32).select("o_orderkey", "batch")


@query("batch_steps", f"""
    SELECT split, count(*) AS rows, CAST(ceil(count(*) / 32.0) AS BIGINT) AS steps
    FROM ({THREE_WAY}) AS t GROUP BY split""")
def batch_steps(spark, sf):
    return splits.batch_steps(splits.split_rows(placed(spark, sf), splits.Split(0.05, 0.2), total="rows_in_all"), 32)


@query("frequency_by_split", f"""
    SELECT split, o_orderstatus, count(*) AS count,
           count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY split)::DOUBLE AS percent
    FROM ({THREE_WAY}) AS t GROUP BY split, o_orderstatus""")
def frequency_by_split(spark, sf):
    split = splits.split_rows(placed(spark, sf), splits.Split(0.05, 0.2), total="rows_in_all")
    return profile.frequency_table(split, "o_orderstatus", by="split")


@query("class_set_check", """
    SELECT role, CAST(max(CAST(turn = 0 AS INT)) AS INT) AS in_train,
           CAST(max(CAST(turn <> 0 AS INT)) AS INT) AS in_validation,
           CAST(max(CAST(turn = 0 AS INT)) = max(CAST(turn <> 0 AS INT)) AS INT) AS matches
    FROM conversations GROUP BY role""")
def class_set_check(spark, sf):
    turns = base.table(spark, sf, "conversations").select(
        "role", F.when(F.col("turn") == 0, splits.TRAIN).otherwise(splits.VALIDATION).alias("split")
    )
    return profile.class_sets(turns, "role")
