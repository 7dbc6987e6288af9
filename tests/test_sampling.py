"""Samples, positions, splits and batches."""

import hashlib

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from listing_analytics.operators import ordinals, sampling, splits


@pytest.fixture(scope="module")
def numbers(spark):
    return spark.range(1000).select((F.col("id") * 37 % 1000).alias("k"), (F.col("id") % 50).alias("g")).repartition(7)


def smallest(keys, n, seed=1):
    return set(sorted(keys, key=lambda k: (hashlib.md5(f"{k}|{seed}".encode()).hexdigest(), k))[:n])


@pytest.mark.parametrize("size,expected", [(1, 1), (1.0, 1), (250, 250), (1000, 1000), (5000, 1000), (0.1, 100),
                                           (0.0005, 0), (0.0015, 2), (0, 0), (0.999, 999)])
def test_exact_size_and_brute_force(numbers, size, expected):
    got = [r.k for r in sampling.sample_rows(numbers, size, "k").collect()]
    assert len(got) == expected and set(got) == smallest(range(1000), expected)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(n=st.integers(1, 60), size=st.integers(0, 70), seed=st.integers(0, 5))
def test_sample_against_brute_force(spark, n, size, seed):
    df = spark.range(n).withColumnRenamed("id", "k")
    got = [r.k for r in sampling.sample_rows(df, size, "k", seed=seed).collect()]
    # below 1 the size is a fraction, so 0 rows
    assert sorted(got) == sorted(smallest(range(n), min(n, size), seed))


def test_sample_does_not_depend_on_partitions(numbers):
    one = {r.k for r in sampling.sample_rows(numbers.coalesce(1), 0.3, "k", seed=4).collect()}
    many = {r.k for r in sampling.sample_rows(numbers.repartition(13, "g"), 0.3, "k", seed=4).collect()}
    assert one == many and len(one) == 300


def test_empty_table(spark):
    empty = spark.range(0).withColumnRenamed("id", "k")
    assert sampling.sample_rows(empty, 5, "k").count() == 0
    assert sampling.sample_rows(empty, 0.5, "k").count() == 0


def test_negative_size(numbers):
    with pytest.raises(ValueError):
        sampling.sample_rows(numbers, -1, "k")


def test_sample_by_key_keeps_whole_groups(numbers):
    got = sampling.sample(numbers, 10, "g", "k").groupBy("g").count().collect()
    assert len(got) == 10 and all(r["count"] == 20 for r in got)
    assert {r.g for r in got} == smallest(range(50), 10)
    assert sampling.sample(numbers, 10, "ALL", "k").count() == 10


def test_sample_with_two_keys(spark):
    df = spark.createDataFrame([(i % 4, f"x{i}") for i in range(40)], "a int, b string")
    got = {(r.a, r.b) for r in sampling.sample_rows(df, 9, "a", "b").collect()}
    keys = [(i % 4, f"x{i}") for i in range(40)]
    expected = sorted(keys, key=lambda k: hashlib.md5(f"{k[0]}|{k[1]}|1".encode()).hexdigest())[:9]
    assert got == set(expected)


def test_ordinals_are_global_positions(numbers):
    for parts in (1, 9):
        got = {r.k: r.ordinal for r in ordinals.with_ordinal(numbers.repartition(parts), "k").collect()}
        assert got == {k: k for k in range(1000)}


def test_ordinals_of_two_columns_and_empty_table(spark, numbers):
    got = [(r.g, r.k) for r in ordinals.with_ordinal(numbers, "g", "k").orderBy("ordinal").collect()]
    assert got == sorted(got) and len(got) == 1000
    assert ordinals.with_ordinal(numbers.where("k < 0"), "k").count() == 0


def test_hot_leading_key_does_not_break_positions(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("g"), "id")
    got = ordinals.with_ordinal(df, "g", "id").orderBy("ordinal").collect()
    assert [r.ordinal for r in got] == list(range(3000))
    assert [(r.g, r.id) for r in got] == sorted((r.g, r.id) for r in got)


def test_shuffled_ordinal_is_a_permutation(numbers):
    got = {r.k: r.ordinal for r in ordinals.with_shuffled_ordinal(numbers, "k", seed=3).collect()}
    order = sorted(range(1000), key=lambda k: hashlib.md5(f"{k}|3".encode()).hexdigest())
    assert got == {k: i for i, k in enumerate(order)}


def parts(df, split):
    rows = splits.split_rows(df, split).collect()
    return {s: sorted(r.ordinal for r in rows if r.split == s) for s in ("train", "validation", "verify")}


def test_three_way_split(spark):
    df = spark.range(100).withColumnRenamed("id", "ordinal")
    got = parts(df, splits.Split(0.05, 0.2))
    assert got == {"train": list(range(76)), "validation": list(range(76, 95)), "verify": list(range(95, 100))}
    head = parts(df, splits.Split(0.05, 0.2, "head"))
    assert head == {"validation": list(range(19)), "train": list(range(19, 95)), "verify": list(range(95, 100))}


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(n=st.integers(1, 200), f=st.floats(0, 0.99), v=st.floats(0, 0.99))
def test_split_cuts(spark, n, f, v):
    got = parts(spark.range(n).withColumnRenamed("id", "ordinal"), splits.Split(f, v))
    rest = int(n - n * f)
    cut = int(rest - rest * v)
    assert (len(got["train"]), len(got["validation"]), len(got["verify"])) == (cut, rest - cut, n - rest)


def test_holdout_tail(spark):
    df = spark.range(100).withColumnRenamed("id", "ordinal")
    assert sorted(r.ordinal for r in splits.holdout_rows(df, 0.05).collect()) == list(range(95, 100))
    one = spark.range(1).withColumnRenamed("id", "ordinal")
    assert splits.holdout_rows(one, 0.5).count() == 1  # nothing before the tail: no split
    with pytest.warns(UserWarning, match="verification split"):
        splits.warn_if_empty(one, 0.5)


def test_bad_fractions():
    with pytest.raises(ValueError):
        splits.Split(1.0, 0.1)
    with pytest.raises(ValueError):
        splits.Split(0.1, 0.1, "middle")


def test_batches(spark):
    df = spark.range(100).withColumnRenamed("id", "ordinal")
    got = splits.batch_index(df, 32).groupBy("batch").count().orderBy("batch").collect()
    assert [tuple(r) for r in got] == [(0, 32), (1, 32), (2, 32), (3, 4)]
    steps = splits.batch_steps(splits.split_rows(df, splits.Split(0.05, 0.2)), 32).collect()
    assert {r.split: r.steps for r in steps} == {"train": 3, "validation": 1, "verify": 1}
    with pytest.raises(ValueError):
        splits.batch_index(df, 0)


def test_buckets_follow_the_number_of_rows():
    from listing_analytics.operators import ordinals

    assert [ordinals.bucket_digits(n) for n in (0, 1, 1 << 20, (1 << 20) + 1, 10 ** 12)] == [1, 1, 1, 2, 6]
