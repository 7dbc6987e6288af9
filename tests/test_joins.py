"""Many-to-one joins."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from listing_analytics.operators import joins


@pytest.fixture(scope="module")
def photos(spark):
    rows = [(f"p{i}", "hot" if i % 3 else f"b{i % 7}") for i in range(60)] + [("p60", None), ("p61", "unknown")]
    return spark.createDataFrame(rows, "photo_id string, business_id string")


@pytest.fixture(scope="module")
def business(spark):
    rows = [("hot", 5.0), ("none", 1.0), (None, 2.0)] + [(f"b{i}", 3.0) for i in range(7)]
    return spark.createDataFrame(rows, "business_id string, stars double")


def rows(df):
    return sorted(tuple(r) for r in df.select(*sorted(df.columns)).fillna(-1.0).fillna("").collect())


@pytest.mark.parametrize("how", joins.MANY_TO_ONE)
def test_salted_join_equals_plain_join(photos, business, how):
    plain = joins.attach(photos, business, "business_id", how)
    salted = joins.attach(photos, business, "business_id", how, salts=5)
    assert rows(plain) == rows(photos.join(business, "business_id", how)) == rows(salted)


@pytest.mark.parametrize("how", joins.MANY_TO_ONE)
def test_hot_join_equals_plain_join(photos, business, how):
    hot = joins.attach_hot(photos, business, "business_id", "photo_id", how, partitions=4)
    plain = joins.attach(photos, business, "business_id", how)
    assert hot.columns == plain.columns and rows(hot) == rows(plain)


def test_hot_keys_are_found(spark, photos):
    assert dict(joins.hot_keys(photos, "business_id", 0.3)) == {"hot": 40}
    assert joins.hot_keys(photos.limit(0), "business_id", 0.3) == []
    assert set(dict(joins.hot_keys(photos, "business_id", 0.02))) >= {"hot", "b0", "b3", "b6"}


def test_hot_keys_are_spread_without_adaptive_execution(spark):
    n = 60_000
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None).otherwise(F.concat(F.lit("b"), F.col("id") % 3000))
    facts = spark.range(n).select(F.concat(F.lit("p"), "id").alias("photo_id"), key.alias("business_id"))
    lookup = facts.select("business_id").distinct().where("business_id is not null").withColumn("stars", F.lit(1.0))
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "20", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        def largest(df):
            sizes = sorted(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("count"), F.max("stars")).collect())
            assert sum(sizes) == n
            return sizes[-1] / sizes[len(sizes) // 2]

        plain = joins.attach(facts, lookup, "business_id")
        hot = joins.attach_hot(facts, lookup, "business_id", "photo_id")
        assert "SortMergeJoin" in hot._jdf.queryExecution().executedPlan().toString()
        assert largest(plain) > 5 and largest(hot) < 2
        assert hot.where("stars is null").count() == plain.where("stars is null").count()
    finally:
        for k in settings:
            spark.conf.unset(k)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_column_order_is_kept(photos, business):
    assert joins.attach(photos, business, "business_id").columns == ["photo_id", "business_id", "stars"]
    assert joins.attach_outer(photos, business, "business_id").columns == ["photo_id", "business_id", "stars"]


def test_outer_equals_full_outer(photos, business):
    expected = photos.join(business, "business_id", "outer")
    assert rows(joins.attach_outer(photos, business, "business_id")) == rows(expected)


def test_outer_with_matching_missing_keys(photos, business):
    p, b = photos.alias("p"), business.alias("b")
    expected = p.join(b, F.col("p.business_id").eqNullSafe(F.col("b.business_id")), "outer").select(
        F.coalesce("p.business_id", "b.business_id").alias("business_id"), "photo_id", "stars"
    )
    assert rows(joins.attach_outer(photos, business, "business_id", match_nulls=True)) == rows(expected)


def test_unknown_join_type(photos, business):
    with pytest.raises(ValueError, match="join type"):
        joins.attach(photos, business, "business_id", "full")


def test_alignment(spark):
    truth = spark.createDataFrame([("a", 1), ("b", 2)], "photo_file string, actual int")
    guess = spark.createDataFrame([("b", 2), ("c", 3)], "photo_file string, predicted int")
    assert [tuple(r) for r in joins.align(truth, guess, "photo_file", unmatched="skip").collect()] == [("b", 2, 2)]
    for left, right in ((truth, guess), (truth, guess.where("predicted = 2")), (truth.where("actual = 2"), guess)):
        with pytest.raises(Exception, match="row in one table only"):
            joins.align(left, right, "photo_file").collect()
    both = joins.align(truth.where("actual = 2"), guess.where("predicted = 2"), "photo_file")
    assert both.columns == ["photo_file", "actual", "predicted"] and [tuple(r) for r in both.collect()] == [("b", 2, 2)]
    with pytest.raises(ValueError, match="unmatched"):
        joins.align(truth, guess, "photo_file", unmatched="drop")
    assert rows(joins.misaligned(truth, guess, "photo_file")) == [("predicted", "c"), ("truth", "a")]


def test_files_of_one_name(spark):
    photos = spark.createDataFrame([("a",)], "photo_id string")
    files = spark.createDataFrame([("a", ".jpg", f"{d}/a.jpg") for d in "zxy"], "stem string, ext string, photo_file string")
    assert [r.photo_file for r in joins.match_files(photos, files, [".jpg"]).collect()] == ["x/a.jpg"]


def test_files_by_extension_order(spark):
    photos = spark.createDataFrame([("a",), ("b",), ("c",)], "photo_id string")
    files = spark.createDataFrame(
        [("a", ".png", "a.png"), ("a", ".jpg", "a.jpg"), ("b", ".png", "b.png"), ("c", ".txt", "c.txt"), ("z", ".jpg", "z.jpg")],
        "stem string, ext string, photo_file string",
    )
    found = joins.match_files(photos, files, [".jpg", ".png"], unmatched="skip")
    assert sorted(tuple(r) for r in found.collect()) == [("a", "a.jpg"), ("b", "b.png")]
    with pytest.raises(PySparkException, match="no file for photo c"):
        joins.match_files(photos, files, [".jpg", ".png"]).collect()
