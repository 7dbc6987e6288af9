"""Row selection on small tables."""

import pytest
from pyspark.sql import functions as F

from listing_analytics.functions import text
from listing_analytics.operators import filters


@pytest.fixture(scope="module")
def business(spark):
    return spark.createDataFrame(
        [("1", "Burgers, Bars", 1.0), ("2", " Burgers ", 2.5), ("3", None, 5.0), ("4", "Bar", 3.0), ("5", "Bars,Zoo", 4.0)],
        "business_id string, categories string, stars double",
    )


@pytest.fixture(scope="module")
def tree(spark):
    return spark.createDataFrame(
        [("restaurants", "Restaurants", []), ("burgers", "Burgers", ["restaurants"]),
         ("gluten_free", "Gluten-Free", ["restaurants", "food"]), ("cheeseburgers", "Cheeseburgers", ["burgers"]),
         ("odd", "Odd", None)],
        "alias string, title string, parent_aliases array<string>",
    )


def ids(df, column="business_id"):
    return sorted(r[column] for r in df.collect() if r[column] is not None)


def test_children_are_one_level_and_include_the_parent(tree):
    found = filters.category_titles(tree, "restaurants")
    assert ids(found, "title") == ["Burgers", "Gluten-Free", "Restaurants"]
    assert ids(filters.category_titles(tree, "nothing"), "title") == []


def test_exclude_is_not_trimmed_unless_asked(tree):
    assert ids(filters.category_titles(tree, "restaurants", "burgers, gluten_free"), "title") == [
        "Gluten-Free", "Restaurants"
    ]
    assert ids(filters.category_titles(tree, "restaurants", "burgers, gluten_free", trim=True), "title") == ["Restaurants"]
    assert filters.category_titles(tree, "restaurants", "").count() == 3


def test_categories_match_whole_stripped_values(spark, business):
    assert ids(filters.filter_categories(business, ["Burgers"])) == ["1", "2"]
    assert ids(filters.filter_categories(business, ["Bars"])) == ["1", "5"]
    assert ids(filters.filter_categories(business, [])) == []
    table = spark.createDataFrame([("Burgers",), ("Bars",), ("Bars",)], "title string")
    assert ids(filters.filter_categories(business, table)) == ["1", "2", "5"]


def test_strip_handles_every_white_space(spark):
    df = spark.createDataFrame([(" \t a b  \n\x1f",)], "c string")
    assert df.select(text.strip(F.col("c"))).head()[0] == "a b"


def test_regex_searches_and_skips_missing(business):
    assert ids(filters.filter_regex(business, "categories", "B.r")) == ["1", "2", "4", "5"]
    with pytest.raises(ValueError, match="not in table"):
        filters.filter_regex(business, "nope", "x")


def test_pattern_may_hold_separators(spark):
    df = spark.createDataFrame([("a:b=c",), ("abc",)], "label string")
    rule = filters.RegexRule("pin", "label", "a:b=c")
    assert filters.apply_filter(df, filters.RowFilter(rule=rule)).count() == 1


def test_rules_last_wins_and_aliases():
    rules = (filters.RegexRule("tip", "a", "1"), filters.RegexRule("tips", "b", "2"), filters.RegexRule("biz", "c", "3"))
    assert filters.rule_for(rules, "tip").column == "b" and filters.rule_for(rules, "tips").column == "b"
    assert filters.rule_for(rules, "biz_photo") is None
    with pytest.raises(ValueError, match="unknown table id"):
        filters.RegexRule("user", "a", "b")


@pytest.mark.parametrize("as_table", [False, True])
def test_semi_and_anti_make_the_whole(spark, as_table):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3), (None, 4)], "business_id string, n int")
    wanted = ["a", "z", "a", None]
    chosen = spark.createDataFrame([(w,) for w in wanted], "id string") if as_table else wanted
    kept, rest = filters.keep_ids(df, chosen), filters.drop_ids(df, chosen)
    assert sorted(r.n for r in kept.collect()) == [1, 3]
    assert sorted(r.n for r in rest.collect()) == [2, 4]  # a missing id is in no list


def test_long_id_list_becomes_a_table(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("business_id"))
    wanted = [str(i) for i in range(0, 4000, 2)]
    kept = filters.keep_ids(df, wanted)
    assert kept.count() == 2000
    assert "LeftSemi" in kept._jdf.queryExecution().optimizedPlan().toString()


def test_excluding_needs_ids(business):
    with pytest.raises(ValueError, match="needs an id list"):
        filters.apply_filter(business, filters.RowFilter(exclude_ids=True))


def test_chain_and_limit(business):
    spec = filters.RowFilter(
        predicate_column="stars", predicate=lambda c: c > 1, rule=filters.RegexRule("biz", "categories", "B"),
        limit=2, order=("business_id",),
    )
    assert ids(filters.apply_filter(business, spec)) == ["2", "4"]
    assert ids(filters.apply_filter(business, spec, ["4", "5"])) == ["4", "5"]
    with pytest.raises(ValueError, match="row limit needs"):
        filters.RowFilter(limit=1)


def test_limit_zero_and_negative(business):
    assert filters.first_rows(business, 0, "business_id").count() == 0
    with pytest.raises(ValueError):
        filters.first_rows(business, -1, "business_id")


def test_first_rows_shuffle_no_rows(spark):
    df = spark.range(300_000).select((F.col("id") * 7 % 300_000).alias("k"), F.lit("x" * 20).alias("text"))
    for n in (1, 300, 100_000, 100_001, 299_999, 300_000, 400_000):
        first = filters.first_rows(df, n, "k")
        assert "Exchange" not in first._jdf.queryExecution().executedPlan().toString()
        got = first.agg(F.count("*"), F.max("k"), F.countDistinct("k")).head()
        assert tuple(got) == (min(n, 300_000), min(n, 300_000) - 1, min(n, 300_000))


ORDERS = {
    "whole": "cast(id * 7919 % 50000 as int)",
    "text": "concat('k', id * 7919 % 50000)",
    "time": "timestamp_micros(id * 7919 % 50000 * 1000001)",
    "day": "date_add(date'1970-01-01', cast(id * 7919 % 50000 as int))",
    "real": "cast(id * 7919 % 50000 as double) / 7",
    "place": "named_struct('file', concat('f', id % 3), 'at', named_struct('block', id % 7, 'row', id))",
    "amount": "cast(id * 7919 % 50000 as decimal(12,2))",
}


@pytest.mark.parametrize("name", sorted(ORDERS))
def test_first_rows_by_keys_of_any_kind(spark, name):
    df = spark.range(50_000).select("id", F.expr(ORDERS[name]).alias("k"))
    df = df.withColumn("k", F.when(F.col("id") % 5000 != 1, F.col("k"))).repartition(5).cache()
    order = [r.id for r in df.orderBy("k", "id").select("id").collect()]
    try:
        for n in (0, 7, 10, 23_456):
            assert sorted(r.id for r in filters.first_rows(df, n, "k", "id").collect()) == sorted(order[:n])
    finally:
        df.unpersist()


@pytest.mark.parametrize("n", [1, 5_999, 6_000, 6_001, 13_000, 19_999])
def test_first_rows_of_repeated_keys(spark, n):
    # a third of the rows without a key, another third with the same one, NaN last
    k = F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, 5.0).when(F.col("id") % 2 == 0, float("nan")).otherwise(F.col("id") / 1e4)
    df = spark.range(20_000).select("id", k.alias("k"))
    first = [r.k for r in filters.first_rows(df, n, "k").collect()]
    order = [r.k for r in df.orderBy("k").limit(n).collect()]
    assert sorted(map(str, first)) == sorted(map(str, order))
