"""Jobs from files to files, on a small set of listings."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from listing_analytics.operators import filters
from listing_analytics.plans import files, photo_dataset, subset
from listing_analytics.sources import lists, tables
from test_images import png
from test_sources import CATEGORIES

BUSINESS = (
    "business_id,name,categories,stars,hours,hours.monday,attributes.Open24Hours\n"
    "b1,One,\"Burgers, Bars\",1.0,{},9-5,True\n"
    "b2,Two,Gluten-Free,2.5,{},,\n"
    "b3,Three,Cheeseburgers,4.0,{},,\n"
    "b4,Four, Burgers ,5.0,{},10-4,False\n"
)
PHOTOS = "photo_id,business_id,label\n" + "".join(f"p{i},b{i % 4 + 1},{'food' if i % 2 else 'inside'}\n" for i in range(12))
REVIEWS = 'text,business_id,stars\n"good, ""very"" good\nindeed",b1,5\nbad,b3,1\n"fine, fine",b4,4\nso so,b2,3\n'


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("listings")
    (root / "categories.json").write_text(json.dumps(CATEGORIES))
    for name, body in (("business", BUSINESS), ("photo", PHOTOS), ("review", REVIEWS)):
        (root / f"{name}.csv").write_text(body)
    (root / "photos").mkdir()
    rng = np.random.default_rng(2)
    for i in range(12):
        pixels = rng.integers(0, 256, (2 + i % 3, 4, 3), dtype=np.uint8)
        (root / "photos" / f"p{i}.png").write_bytes(png(pixels, 2))
    return root


def paths(folder, *names):
    return {n: str(folder / f"{n}.csv") for n in names}


def test_all_in_one(spark, folder, tmp_path):
    spec = subset.SubsetSpec(parent="restaurants", exclude="gluten_free",
                             rules=(filters.RegexRule("pin", "label", "food"),), drop="^name$")
    rows = files.extract_subset(
        spark, spec, paths(folder, "business", "review", "photo"), str(tmp_path), categories_json=str(folder / "categories.json")
    )
    assert rows == {"business": 2, "review": 2, "photo": 3}
    assert sorted(r.value for r in lists.read_lines(spark, f"{tmp_path}/categories").collect()) == ["Burgers", "Restaurants"]
    assert sorted(r.value for r in lists.read_lines(spark, f"{tmp_path}/business_ids").collect()) == ["b1", "b4"]
    business = tables.read_entity(spark, f"{tmp_path}/business", "business")
    assert business.columns == ["business_id", "categories", "stars", "hours.monday", "attributes.Open24Hours"]
    reviews = tables.read_entity(spark, f"{tmp_path}/review", "review")
    assert {r.text for r in reviews.collect()} == {'good, "very" good\nindeed', "fine, fine"}


def test_lists_and_limits_in_file_order(spark, folder, tmp_path):
    (folder / "cats.txt").write_text("Burgers  \nGluten-Free\n")
    rows = files.extract_subset(
        spark, subset.SubsetSpec(limit=2), paths(folder, "business", "photo"), str(tmp_path), category_list=str(folder / "cats.txt")
    )
    assert rows == {"business": 2, "photo": 2}
    assert sorted(r.value for r in lists.read_lines(spark, f"{tmp_path}/business_ids").collect()) == ["b1", "b2"]
    photo = tables.read_entity(spark, f"{tmp_path}/photo", "photo")
    assert photo.columns == ["photo_id", "business_id", "label"]
    assert sorted(r.photo_id for r in photo.collect()) == ["p0", "p1"]


def test_first_rows_of_the_files(spark, folder):
    got = files.read_tables(spark, paths(folder, "photo"), nrows=5)["photo"]
    assert sorted(r.photo_id for r in got.collect()) == [f"p{i}" for i in range(5)]
    assert "file_order" not in got.columns


@pytest.mark.parametrize("multi_line", [False, True])
def test_file_order_over_splits_and_files(spark, tmp_path, multi_line):
    for part in range(3):
        body = "".join(f"{part * 2000 + i}\n" for i in range(2000))
        (tmp_path / f"part{part}.csv").write_text("n\n" + body)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        df = tables.read_text_table(spark, str(tmp_path), multi_line=multi_line, file_order="at")
        assert df.rdd.getNumPartitions() > 3
        assert [int(r.n) for r in df.orderBy("at").collect()] == list(range(6000))
        first = filters.first_rows(df, 2500, "at")
        assert sorted(int(r.n) for r in first.collect()) == list(range(2500))
        assert first.columns == ["n", "at"]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_dataset_and_resize(spark, folder, tmp_path):
    (tmp_path / "ids.txt").write_text("b1\nb4\nb1\n")
    n = files.build_photo_dataset(
        spark, str(folder / "business.csv"), str(folder / "photo.csv"), str(folder / "photos"), str(tmp_path / "set"),
        id_list=str(tmp_path / "ids.txt"), ids_out=str(tmp_path / "ids_out"),
    )
    assert n == 6
    dataset = tables.read_photo_dataset(spark, str(tmp_path / "set"))
    one = {r.photo_id: r for r in dataset.collect()}["p3"]
    assert (one.business_id, one.stars_cat, one.stars_num, one.photo_file) == ("b4", "5_0", 10, "p3.png")
    assert (one.format, one.width, one.height, one.mode) == ("PNG", 4, 2, "RGB") and one.stars_ord == [1] * 8 + [0]
    assert sorted(r.value for r in lists.read_lines(spark, str(tmp_path / "ids_out")).collect()) == ["b1", "b4"]
    assert files.resize_photo_set(spark, str(tmp_path / "set"), str(folder / "photos"), (6, 5), str(tmp_path / "small")) == 6
    resized = spark.read.parquet(str(tmp_path / "small"))
    assert {(r.width, r.height, len(r.data)) for r in resized.collect()} == {(6, 5, 90)}


def test_unreadable_files_matter_only_to_their_photos(spark, folder, tmp_path):
    photo_folder = tmp_path / "photos"
    photo_folder.mkdir()
    for name in ("p3.png", "p7.png", "p11.png"):
        (photo_folder / name).write_bytes((folder / "photos" / name).read_bytes())
    (photo_folder / "other.png").write_bytes(b"broken")
    (photo_folder / "p3.txt").write_bytes(b"not tried")
    (tmp_path / "ids.txt").write_text("b4\n")

    def build(out):
        return files.build_photo_dataset(
            spark, str(folder / "business.csv"), str(folder / "photo.csv"), str(photo_folder), str(tmp_path / out),
            id_list=str(tmp_path / "ids.txt"),
        )

    assert build("good") == 3
    (photo_folder / "p7.png").write_bytes(b"broken")
    with pytest.raises(Exception, match="not a known picture"):
        build("bad")
    (photo_folder / "p7.png").unlink()
    with pytest.raises(Exception, match="no file for photo p7"):
        build("missing")


def test_dataset_report(spark, folder, tmp_path):
    with open(folder / "photo.csv", "a") as f:
        f.write(",b1,food\n,b1,food\n")
    try:
        report = files.build_photo_dataset_report(
            spark, str(folder / "business.csv"), str(folder / "photo.csv"), str(folder / "photos"), str(tmp_path / "set"),
            sample=photo_dataset.Sample(0.5), ids_out=str(tmp_path / "ids"),
        )
    finally:
        lines = (folder / "photo.csv").read_text().splitlines(keepends=True)
        (folder / "photo.csv").write_text("".join(lines[:-2]))
    assert (report.loaded, report.dropped, report.written) == (14, 2, 6)
    assert tables.read_photo_dataset(spark, str(tmp_path / "set")).count() == 6
    again = tables.read_photo_dataset(spark, str(tmp_path / "set"), file_order="at").orderBy("at").select("business_id", "photo_id")
    assert [tuple(r) for r in again.collect()] == sorted(tuple(r) for r in again.collect())
    assert report.profile["width"].agg(F.sum("count")).head()[0] == 6


def test_sampled_dataset_from_files(spark, folder, tmp_path):
    n = files.build_photo_dataset(
        spark, str(folder / "business.csv"), str(folder / "photo.csv"), str(folder / "photos"), str(tmp_path / "set"),
        sample=photo_dataset.Sample(0.5),
    )
    assert n == 6
