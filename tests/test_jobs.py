"""Whole jobs, their plans, streams, and the shared folder."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from listing_analytics import session, staging
from listing_analytics.operators import filters, joins, sampling, splits
from listing_analytics.plans import photo_dataset as dataset_plan, subset as plan
from listing_analytics.sources import lists, tables
from listing_analytics.streaming.extract import extract_stream, read_new_files

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def business(spark):
    return spark.createDataFrame(
        [("1", "Burgers", 1.0, "{}", "a", "x"), ("2", "Bars", 2.5, "{}", None, "y"), ("3", "Burgers, Bars", 5.0, "{}", "b", "z")],
        "business_id string, categories string, stars double, attributes string, `attributes.kind` string, note string",
    )


@pytest.fixture(scope="module")
def photos(spark):
    return spark.createDataFrame(
        [("p1", "1", "food"), ("p2", "1", "inside"), ("p3", "3", "food"), ("p4", "9", "food"), (None, "1", "food"), ("p5", None, "food")],
        "photo_id string, business_id string, label string",
    )


@pytest.fixture(scope="module")
def files(spark):
    rows = [(f"p{i}", e, f"p{i}{e}", "JPEG", 4, 3, "RGB") for i in range(1, 6) for e in (".png", ".jpg")]
    return spark.createDataFrame(
        rows, "stem string, ext string, photo_file string, format string, width int, height int, mode string"
    )


def test_business_extract(business):
    out = plan.business_extract(business, plan.SubsetSpec(drop="note"), ["Bars"])
    assert out.columns == ["business_id", "categories", "stars", "attributes.kind"]
    assert sorted((r[0], r[3]) for r in out.collect()) == [("2", ""), ("3", "b")]
    with pytest.raises(ValueError, match="needed columns"):
        plan.business_extract(business, plan.SubsetSpec(drop="_id"), ["Bars"])
    assert plan.business_extract(business, plan.SubsetSpec(), ids=["3"]).count() == 1


def test_filter_runs_before_columns_drop(business):
    spec = plan.SubsetSpec(rules=(filters.RegexRule("biz", "note", "x"),), drop="note")
    assert [r.business_id for r in plan.business_extract(business, spec, ["Burgers"]).collect()] == ["1"]


def test_subset_run_and_write(spark, business, photos, tmp_path):
    tips = spark.createDataFrame([("1", "t"), ("7", "u"), ("3", "v")], "business_id string, text string")
    spec = plan.SubsetSpec(rules=(filters.RegexRule("pin", "label", "food"),))
    subset = plan.run_subset(spec, business=business, categories=["Burgers"], photo=photos, tip=tips)
    assert sorted(r[0] for r in subset.ids.collect()) == ["1", "3"]
    written = plan.write_subset(subset, str(tmp_path))
    assert written == {"business": 2, "photo": 3, "tip": 2}
    assert sorted(r.value for r in lists.read_lines(spark, f"{tmp_path}/business_ids").collect()) == ["1", "3"]
    assert tables.read_entity(spark, f"{tmp_path}/photo", "photo").count() == 3
    # the written id list feeds a later run
    again = plan.run_subset(plan.SubsetSpec(), ids=lists.read_lines(spark, f"{tmp_path}/business_ids"), tip=tips)
    assert again.records["tip"].count() == 2 and again.business is None


def test_limit_caps_every_table(business, photos):
    spec = plan.SubsetSpec(limit=1, order={"business": ("business_id",), "photo": ("photo_id",)})
    subset = plan.run_subset(spec, business=business, categories=["Burgers"], photo=photos.where("photo_id is not null"))
    assert subset.business.count() == 1 and subset.records["photo"].count() == 1
    with pytest.raises(ValueError, match="row limit needs"):
        plan.run_subset(plan.SubsetSpec(limit=1), business=business, categories=["Burgers"])


def test_subset_needs_ids(business, photos):
    with pytest.raises(ValueError, match="id list"):
        plan.run_subset(plan.SubsetSpec(), photo=photos)
    with pytest.raises(ValueError, match="unknown entities"):
        plan.run_subset(plan.SubsetSpec(), ids=["1"], user=photos)


def test_photo_dataset(spark, business, photos, files, tmp_path):
    out = dataset_plan.photo_dataset(business, photos, files, [".jpg", ".png"])
    rows = {r.photo_id: r for r in out.collect()}
    assert set(rows) == {"p1", "p2", "p3", "p4", "p5"}  # no photo, no row; an unknown business stays
    assert rows["p3"].photo_file == "p3.jpg" and rows["p3"].stars_ord == [1] * 8 + [0]
    assert rows["p4"].stars is None and rows["p5"].stars_ord is None
    profile = dataset_plan.dataset_profile(out)
    assert tuple(profile["range"].head()) == (4, 4, 3, 3)
    assert profile["stars_ord"].count() == 3
    assert dataset_plan.write_photo_dataset(out, str(tmp_path / "d"), str(tmp_path / "ids")) == 5
    back = tables.read_photo_dataset(spark, str(tmp_path / "d"))
    assert sorted(map(str, back.collect())) == sorted(map(str, out.collect()))


def test_photo_rules_do_not_touch_the_dataset_businesses(business, photos, files):
    spec = plan.SubsetSpec(rules=(filters.RegexRule("biz", "note", "none"), filters.RegexRule("pin", "label", "food")))
    out = dataset_plan.photo_dataset(business, photos, files, [".jpg"], spec, ids=["1", "3"])
    assert sorted(r.photo_id for r in out.collect()) == ["p1", "p3"]
    assert out.where("stars is null").count() == 0


def test_sampled_dataset(business, photos, files):
    by_row = dataset_plan.photo_dataset(business, photos, files, [".jpg"], sample=dataset_plan.Sample(2))
    assert by_row.count() == 2
    by_key = dataset_plan.labelled_photos(business, photos, sample=dataset_plan.Sample(1, "business_id"))
    assert by_key.select("business_id").distinct().count() == 1


def test_prefilter_is_written(spark, photos):
    out = plan.staged_prefilter(photos, ["1"], plan.SubsetSpec(rules=(filters.RegexRule("pin", "label", "food"),)), "photo")
    assert out.count() == 2
    assert all(staging.ROOT in f for f in out.inputFiles())


class Conf(dict):
    def get(self, key, default=None):
        return dict.get(self, key, default)


class FakeSession:
    """A session of which only the folder settings are asked."""

    def __init__(self, conf, master, context_dir=None):
        self.conf, self.sparkContext = Conf(conf), self
        self.master, self.getCheckpointDir = master, lambda: context_dir


def test_shared_folder_comes_from_the_session():
    assert session.shared_dir(FakeSession({"spark.checkpoint.dir": "hdfs:///x/"}, "yarn")) == "hdfs:///x"
    assert session.shared_dir(FakeSession({}, "yarn", "hdfs:///y")) == "hdfs:///y"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(FakeSession({}, "yarn"))


def test_stages_are_written_and_cleared(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(staging, "shared_dir", lambda _: str(tmp_path))
    assert staging.stage(spark.range(3)).count() == 3
    assert (tmp_path / staging.ROOT).exists()
    other = tmp_path / staging.ROOT / "another-application"
    other.mkdir()
    staging.clear_stages(spark)
    assert [p.name for p in (tmp_path / staging.ROOT).iterdir()] == [other.name]


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_outer_join_and_filter_is_a_left_join(business, photos):
    joined = photos.join(business, "business_id", "outer").where("photo_id is not null")
    assert "LeftOuter" in optimized(joined)
    assert "FullOuter" not in optimized(joins.attach_outer(photos, business, "business_id"))


@pytest.mark.parametrize("name", ["id_semi_filter", "reviews_for_ids", "column_range", "frequency_table", "value_counts"])
def test_scans_read_only_needed_columns(spark, name):
    for line in physical(entry.queries()[name](spark, SF)).splitlines():
        if "FileScan" in line and "lineitem" in line:
            assert line.count(":", line.index("ReadSchema")) <= 5


def test_sample_moves_no_whole_rows(spark):
    df = spark.read.parquet(f"{SF}/orders.parquet")
    text = physical(sampling.sample_rows(df, 0.5, "o_orderkey"))
    assert "Exchange" not in text and "Join" not in text


def test_split_has_no_global_window(spark):
    df = spark.range(100).withColumnRenamed("id", "ordinal")
    assert "Window" not in physical(splits.split_rows(df, splits.Split(0.1, 0.1)))


@pytest.fixture
def small_partitions(spark):
    """Every join shuffles, and a partition of some kilobytes counts as large."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)


@pytest.fixture
def hot(spark):
    """Photos of which a third belong to one business."""
    ids = spark.range(0, 60000, 1, 16)
    return ids.select(
        F.col("id").cast("string").alias("photo_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 5000 + 1).cast("string")).alias("business_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("label"),
    )


@pytest.fixture
def many(spark):
    return spark.range(6000).select(
        F.when(F.col("id") == 0, "hot").otherwise(F.col("id").cast("string")).alias("business_id"),
        F.lit("Bars").alias("categories"), (F.col("id") % 9 / 2 + 1).alias("stars"),
    )


@pytest.mark.parametrize("job", ["semi", "left", "outer", "dataset"])
def test_hot_business_is_split(spark, small_partitions, hot, many, job):
    ids = many.select("business_id")
    df = {
        "semi": lambda: filters.keep_ids(hot, ids),
        "left": lambda: joins.attach(hot, many, "business_id"),
        "outer": lambda: joins.attach_outer(hot, many, "business_id"),
        "dataset": lambda: dataset_plan.labelled_photos(many, hot, ids=ids),
    }[job]()
    rows = df.collect()
    assert "skew=true" in physical(df)
    assert len({r.photo_id for r in rows} - {None}) == 60000


def test_stream_equals_batch(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet").withColumn("business_id", F.col("user_id").cast("string"))
    source = tmp_path / "in"
    events.repartition(3).write.parquet(str(source))
    ids = spark.createDataFrame([("3",), ("8",), ("46",)], "business_id string")
    spec = plan.SubsetSpec(rules=(filters.RegexRule("tip", "event_type", "^(view|click)$"),))
    stream = read_new_files(spark, str(source), events.schema)
    for _ in range(2):  # the second run finds nothing new
        extract_stream(stream, ids, spec, "tip", str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    expected = plan.records_for_ids(events, ids, spec, "tip")
    assert got.count() == expected.count() > 0
    assert got.exceptAll(expected).count() == 0
    with pytest.raises(ValueError, match="no meaning"):
        extract_stream(stream, ids, plan.SubsetSpec(limit=1, order={"tip": ("event_id",)}), "tip", "x", "y")
