"""Columns and labels."""

import pytest
from pyspark.sql import functions as F

from listing_analytics.operators import evaluation, projections


@pytest.fixture(scope="module")
def stars(spark):
    return spark.createDataFrame([("a", 1.0), ("b", 2.5), ("c", 5.0)], "business_id string, stars double")


def test_labels(stars):
    rows = {r.stars: r for r in projections.add_labels(stars).collect()}
    assert {s: r.stars_cat for s, r in rows.items()} == {1.0: "1_0", 2.5: "2_5", 5.0: "5_0"}
    assert {s: r.stars_num for s, r in rows.items()} == {1.0: 2, 2.5: 5, 5.0: 10}
    assert {s: sum(r.stars_ord) for s, r in rows.items()} == {1.0: 0, 2.5: 3, 5.0: 8}
    assert all(len(r.stars_ord) == 9 and r.stars_ord == sorted(r.stars_ord, reverse=True) for r in rows.values())


def test_label_decodes_to_its_star(stars):
    labelled = projections.add_labels(stars)
    decoded = evaluation.decode_ordinal(labelled, base=2, outputs="stars_ord")
    assert all(r.predicted == r.stars * 2 for r in decoded.collect())
    low = evaluation.decode_ordinal(labelled, base=1, outputs="stars_ord")
    assert all(r.predicted == r.stars * 2 - 1 for r in low.collect())


def test_label_range_can_come_from_another_table(spark, stars):
    two = stars.where("stars < 3")
    lists = projections.add_labels(two, scale=stars).select(F.size("stars_ord")).distinct().collect()
    assert [r[0] for r in lists] == [9]


def test_missing_stars_keep_null_labels(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", None)], "id string, stars double")
    row = projections.add_labels(df).where("id = 'b'").head()
    assert row.stars_cat is None and row.stars_ord is None and row.stars_num is None


def test_drop_matching(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`a.b` int, ab int, c int")
    assert projections.drop_matching(df, r"^a\.").columns == ["ab", "c"]
    assert projections.drop_matching(df, "b").columns == ["c"]
    with pytest.raises(ValueError, match="needed columns"):
        projections.drop_matching(df, "b", keep=("ab",))


def test_drop_expanded_roots(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "a int, `a.b` int, `a.b.c` int, d int")
    assert projections.drop_expanded_roots(df).columns == ["a.b.c", "d"]


def test_fill_missing(spark):
    df = spark.createDataFrame([(None, None)], "`x.y` string, n int")
    assert tuple(projections.fill_missing(df).head()) == ("", None)


def test_split_and_expand(spark):
    df = spark.createDataFrame([("f.jpg,JPEG,4,3",)], "attrib string")
    out = projections.split_to_columns(
        df, "attrib", ["photo_file", "format", "width", "height", "mode"], {"width": "int", "height": "int"}
    ).head()
    assert tuple(out)[1:] == ("f.jpg", "JPEG", 4, 3, None)
    lists = spark.createDataFrame([([1, 0],), ([1, 1, 1],)], "stars_ord array<int>")
    assert projections.expand_list(lists, "stars_ord").columns == ["stars_ord", "t0", "t1", "t2"]


@pytest.mark.parametrize("mode,expected", [("sparse", {"a": 0, "b": 1}), ("binary", {"a": 0, "b": 1}),
                                           ("categorical", {"a": [1, 0], "b": [0, 1]})])
def test_targets(spark, mode, expected):
    df = spark.createDataFrame([("b",), ("a",), ("b",)], "cat string")
    assert {r.cat: r.target for r in projections.encode_target(df, "cat", mode).collect()} == expected


def test_raw_targets_and_unknown_mode(spark):
    df = spark.createDataFrame([("b", [1, 0])], "cat string, stars_ord array<int>")
    assert projections.encode_target(df, "cat", "raw").columns[-2:] == ["t0", "t1"]
    with pytest.raises(ValueError, match="class mode"):
        projections.encode_target(df, "cat", "multi_output")


def test_class_map(stars):
    rows = projections.class_map(projections.add_labels(stars), "stars_cat").collect()
    assert [tuple(r) for r in rows] == [(0, "1_0", 1.0), (1, "2_5", 2.5), (2, "5_0", 5.0)]
