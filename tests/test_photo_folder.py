"""Photo folders as a data source, and several sizes from one pass."""

import os

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from listing_analytics.operators import images
from listing_analytics.plans import files as jobs
from listing_analytics.sources import photo_folder, photos


def tree(root):
    return sorted(os.path.relpath(os.path.join(d, f), root) for d, _, names in os.walk(root) for f in names if not f.endswith(".crc"))


def test_round_trip(spark, tmp_path):
    out = str(tmp_path / "out")
    rows = [(f"{'sub/' if i % 3 else ''}p{i}.{'png' if i % 2 else 'jpg'}", bytes([i]) * i) for i in range(40)]
    df = spark.createDataFrame(rows, "photo_file string, content binary").repartition(4)
    photo_folder.write_folder(df, out)
    got = photo_folder.read_folder(spark, out, partitions=5)
    assert sorted((r.photo_file, bytes(r.content), r.length) for r in got.collect()) == sorted(
        (name.split("/")[-1], content, len(content)) for name, content in rows
    )
    assert got.rdd.getNumPartitions() == 5
    assert not os.path.exists(f"{out}/_temporary")
    names = photo_folder.read_folder(spark, out, (".PNG",), contents=False).collect()
    assert len(names) == 20 and all(r.content is None for r in names)
    # other writes add to the folder, or replace what earlier ones wrote
    photo_folder.write_folder(df.limit(3), out, mode="append")
    assert len(tree(out)) == 43
    (tmp_path / "out" / "own.png").write_bytes(b"x")
    photo_folder.write_folder(df.limit(2), out)
    assert len(tree(out)) == 3 and "own.png" in tree(out)


def test_hidden_folders_and_flat_folders(spark, tmp_path):
    for name in ("a.png", "b.png", "_hidden.png", "_temporary/c.png", "d/e/f.png", "d/.g/h.png"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"1")
    for partitions in (1, 3, 50):
        got = photo_folder.read_folder(spark, f"file://{tmp_path}", partitions=partitions)
        assert sorted(r.photo_file for r in got.collect()) == ["a.png", "b.png", "f.png"]
    (tmp_path / "empty").mkdir()
    assert photo_folder.read_folder(spark, str(tmp_path / "empty")).count() == 0


def test_failed_jobs_leave_no_file(spark, tmp_path):
    out = str(tmp_path / "out")
    good = spark.createDataFrame([(f"p{i}.png", b"1") for i in range(20)], "photo_file string, content binary")
    photo_folder.write_folder(good, out)
    before = tree(out)
    bad = good.repartition(4).withColumn(
        "content", F.when(F.col("photo_file") == "p7.png", F.raise_error(F.lit("broken")).cast("binary")).otherwise(F.col("content"))
    )
    with pytest.raises(Exception, match="broken"):
        photo_folder.write_folder(bad, out)
    assert tree(out) == before
    for name, match in (("p1.png", "two files"), ("../x.png", "not a file name"), (None, "not a file name")):
        with pytest.raises(Exception, match=match):
            photo_folder.write_folder(spark.createDataFrame([(name, b"1"), ("p1.png", b"2")], "photo_file string, content binary").coalesce(1), out)
    with pytest.raises(Exception, match="no content"):
        photo_folder.write_folder(spark.createDataFrame([("p1.png", None)], "photo_file string, content binary"), out)
    assert tree(out) == before
    with pytest.raises(ValueError, match="mode"):
        photo_folder.write_folder(good, out, mode="ignore")


def test_attempts_that_fail_are_not_committed(tmp_path):
    writer = photo_folder.PhotoWriter({"path": str(tmp_path)}, overwrite=False)

    def batches(fail):
        yield pa.RecordBatch.from_pydict({"photo_file": ["a.png"], "content": [b"1"]})
        if fail:
            raise OSError("lost")

    with pytest.raises(OSError):
        writer.write(batches(True))
    writer.commit([writer.write(batches(False)), writer.write(iter(())), None])
    assert len(tree(tmp_path)) == 1 and not (tmp_path / "_temporary").exists()


@pytest.mark.parametrize("late", ["b.png", "sub/b.png", "sub/deep/b.png"])
def test_attempts_that_outlive_their_job_leave_no_file(tmp_path, late):
    def batch(name):
        return pa.RecordBatch.from_pydict({"photo_file": [name], "content": [b"1"]})

    def batches(writer):
        yield batch("a.png")
        writer.abort([])
        yield batch(late)

    writer = photo_folder.PhotoWriter({"path": str(tmp_path)}, overwrite=False)
    with pytest.raises(OSError):
        writer.write(batches(writer))
    with pytest.raises(OSError):
        writer.write(iter([batch(late)]))
    assert os.listdir(tmp_path) == []


def test_png_files_are_read_back(spark, tmp_path):
    draw = np.random.default_rng(2)
    rows = [(f"p{c}.jpeg", w, h, c, draw.integers(0, 256, w * h * c, dtype=np.uint8).tobytes()) for c, w, h in ((1, 5, 3), (3, 4, 7), (4, 1, 2))]
    pictures = spark.createDataFrame(rows, images.PIXELS)
    photo_folder.write_folder(images.as_png(pictures), str(tmp_path / "png"))
    part = next(p for p in os.listdir(tmp_path / "png") if p.startswith("part-"))
    back = photos.read_pictures(spark, str(tmp_path / "png" / "part-*")).collect()
    assert part and sorted((r.photo_file, r.width, r.height, r.channels, bytes(r.data)) for r in back) == sorted(
        (f"p{c}.png", w, h, c, data) for _, w, h, c, data in rows
    )
    assert images.picture_header(images.png(2, 1, 2, b"1234"))[3] == "LA"


def test_sizes_of_one_pass_equal_single_ones(spark):
    draw = np.random.default_rng(3)
    rows = [(f"p{i}", w, h, c, draw.integers(0, 256, w * h * c, dtype=np.uint8).tobytes()) for i, (w, h, c) in enumerate(
        [(9, 4, 3), (2, 2, 1), (30, 1, 4), (5, 8, 3)])] + [("none", 0, 0, 3, b"")]
    pictures = spark.createDataFrame(rows, images.PIXELS)
    sizes = [7, (3, 9), 40]
    sets = images.letterbox_sets(pictures, sizes)
    assert sets.count() == 12
    for size in sizes:
        name = "{}x{}".format(*(size if isinstance(size, tuple) else (size, size)))
        one = images.letterbox_images(pictures, size)
        assert sets.where(F.col("size") == name).drop("size").exceptAll(one).count() == 0 and one.count() == 4
    with pytest.raises(ValueError, match="size"):
        images.letterbox_sets(pictures, [])


def test_large_canvases_come_in_pieces(spark):
    # one batch of 200 small pictures makes 200 x (3 MB + 0.75 MB): what is held at a time stays below the bound
    box = {"new_width": 2, "new_height": 2, "left": 0, "top": 0}
    boxes = [{"wide": 1000, "high": 1000, **box}, {"wide": 500, "high": 500, **box}]
    batch = pa.RecordBatch.from_pylist([
        {"photo_file": f"p{i}", "width": 2, "height": 2, "channels": 1, "data": b"\x01\x02\x03\x04", "boxes": boxes} for i in range(200)
    ])
    n = 0
    for piece in images.letterbox_pieces(iter([batch])):
        assert piece.nbytes < images.PIECE_BYTES + 1_000_000
        n += len(piece)
    assert n == 400
    one = spark.createDataFrame([("p", 2, 2, 1, b"\x01\x02\x03\x04")], images.PIXELS)
    # a canvas beyond the bound is a piece of its own
    assert [r.width * r.height for r in images.letterbox_sets(one, [(3000, 2000), 3]).collect()] == [6_000_000, 9]


def test_resize_to_files(spark, tmp_path):
    (tmp_path / "photos").mkdir()
    for i in range(3):
        (tmp_path / "photos" / f"p{i}.png").write_bytes(images.png(4, 2, 3, bytes([i]) * 24))
    header = "business_id,stars,stars_cat,stars_ord,stars_num,photo_id,photo_file,format,width,height,mode\n"
    lines = "".join(f'b,1.0,1_0,"[0]",2,p{i},p{i}.png,PNG,4,2,RGB\n' for i in range(2))
    (tmp_path / "set.csv").write_text(header + lines)
    n = jobs.resize_photo_files(spark, str(tmp_path / "set.csv"), str(tmp_path / "photos"), [6, (3, 2)], str(tmp_path / "out"))
    assert n == 4 and sorted("/".join(p.split("/")[1:]) for p in tree(tmp_path / "out")) == ["3x2/p0.png", "3x2/p1.png", "6x6/p0.png", "6x6/p1.png"]
    got = photo_folder.read_folder(spark, str(tmp_path / "out"))
    read = images.image_attributes(got.select("path", "content"))
    assert sorted((r.width, r.height) for r in read.collect()) == [(3, 2), (3, 2), (6, 6), (6, 6)]
