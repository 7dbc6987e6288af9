"""Photo files, headers and pixels."""

import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from listing_analytics.functions.sizes import canvas
from listing_analytics.operators import images
from listing_analytics.registry import QUERIES
from listing_analytics.sources import photos

MODES = {0: 1, 2: 3, 6: 4}


def png(pixels, colour):
    """A PNG of a (height, width, channels) array in RGB(A) order."""
    def chunk(kind, body):
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    height, width, _ = pixels.shape
    head = struct.pack(">IIBBBBB", width, height, 8, colour, 0, 0, 0)
    lines = b"".join(b"\0" + row.tobytes() for row in pixels)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(lines)) + chunk(b"IEND", b"")


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("photos")
    rng = np.random.default_rng(0)
    for name, colour, (h, w) in (("grey", 0, (3, 5)), ("rgb", 2, (4, 2)), ("rgba", 6, (2, 2))):
        (path / f"{name}.png").write_bytes(png(rng.integers(0, 256, (h, w, MODES[colour]), dtype=np.uint8), colour))
    (path / "broken.png").write_bytes(b"not a picture")
    return str(path)


def test_attributes_from_files(spark, folder):
    read = images.image_attributes(photos.read_photos(spark, folder), unreadable="keep")
    got = {r.stem: (r.format, r.width, r.height, r.mode) for r in read.collect()}
    assert got == {
        "grey": ("PNG", 5, 3, "L"), "rgb": ("PNG", 2, 4, "RGB"), "rgba": ("PNG", 2, 2, "RGBA"),
        "broken": (None, None, None, None),
    }
    assert images.image_attributes(photos.read_photos(spark, folder), unreadable="drop").count() == 3
    with pytest.raises(Exception, match="not a known picture"):
        images.image_attributes(photos.read_photos(spark, folder)).collect()


def test_headers_agree_with_the_image_source(spark, folder):
    headers = images.image_attributes(photos.read_photos(spark, folder), unreadable="drop")
    decoded = photos.read_pictures(spark, folder, drop_invalid=True)
    both = headers.select("stem", "width", "height").exceptAll(decoded.select("stem", "width", "height"))
    assert both.count() == 0 and decoded.count() == 3


def test_jpeg_headers():
    frame = b"\xff\xc2\x00\x0b\x08" + struct.pack(">HHB", 30, 40, 1) + b"\0" * 4
    long_segment = b"\xff\xe1" + struct.pack(">H", 65535) + b"\0" * 65533
    content = b"\xff\xd8" + long_segment + long_segment + b"\xff\xff" + frame[1:]
    assert images.picture_header(content) == ("JPEG", 40, 30, "L")
    cmyk = b"\xff\xd8\xff\xc0\x00\x14\x08" + struct.pack(">HHB", 7, 9, 4) + b"\0" * 12
    assert images.picture_header(cmyk) == ("JPEG", 9, 7, "CMYK")
    assert images.picture_header(b"\xff\xd8\x00\x00" + b"\0" * 20) is None
    assert images.picture_header(b"") is None and images.picture_header(None) is None


def test_header_beyond_the_first_bytes(spark):
    segment = b"\xff\xe1" + struct.pack(">H", 65535) + b"\0" * 65533
    far = b"\xff\xd8" + segment * 2 + b"\xff\xc0\x00\x11\x08" + struct.pack(">HHB", 21, 34, 3) + b"\0" * 20
    near = b"\xff\xd8\xff\xc0\x00\x11\x08" + struct.pack(">HHB", 5, 6, 3) + b"\0" * 200000
    df = spark.createDataFrame([("far", far), ("near", near)], "name string, content binary")
    got = {r["name"]: (r.width, r.height) for r in images.image_attributes(df).collect()}
    assert got == {"far": (34, 21), "near": (6, 5)}


@pytest.mark.parametrize("size,expected", [((150, 100), (150, 100, 0, 0)), (299, (299, 199, 0, 50))])
def test_letterbox_by_hand(spark, size, expected):
    df = spark.createDataFrame([(600, 400)], "width int, height int")
    assert tuple(images.letterbox_plan(df, size).head())[2:] == expected


def test_canvas_size():
    assert canvas(5) == (5, 5) and canvas((3, 2)) == (3, 2)
    with pytest.raises(ValueError):
        canvas(0)


def test_resampling_weights():
    for old, new in ((4, 8), (9, 3), (5, 5), (7, 1)):
        weights = images.lanczos_weights(old, new)
        assert weights.shape == (new, old) and np.allclose(weights.sum(axis=1), 1)
    assert np.allclose(images.lanczos_weights(6, 6), np.eye(6))


def test_letterbox_pixels(spark, folder):
    pictures = photos.read_pictures(spark, folder, drop_invalid=True)
    same = {r.photo_file: r for r in pictures.collect()}["rgb.png"]
    boxed = {r.photo_file: r for r in images.letterbox_images(pictures, (6, 4)).collect()}
    assert set(boxed) == {"grey.png", "rgb.png", "rgba.png"}
    out = np.frombuffer(boxed["rgb.png"].data, np.uint8).reshape(4, 6, 3)
    # the 2 x 4 picture keeps its size and stands in the middle
    assert np.array_equal(out[:, 2:4], np.frombuffer(same.data, np.uint8).reshape(4, 2, 3))
    assert not out[:, :2].any() and not out[:, 4:].any()
    grey = np.frombuffer(boxed["grey.png"].data, np.uint8).reshape(4, 6, 3)
    assert (grey[:, :, 0] == grey[:, :, 1]).all() and (grey[:, :, 1] == grey[:, :, 2]).all()


def test_flat_colour_stays_flat_and_thin_pictures_stay_black(spark):
    rows = [("flat", 10, 10, 3, bytes([9, 99, 199]) * 100), ("thin", 500, 1, 1, b"\xff" * 500)]
    df = spark.createDataFrame(rows, "photo_file string, width int, height int, channels int, data binary")
    out = {r.photo_file: np.frombuffer(r.data, np.uint8).reshape(7, 7, 3) for r in images.letterbox_images(df, 7).collect()}
    assert (out["flat"] == [9, 99, 199]).all()
    assert not out["thin"].any()  # one pixel high: nothing is left at a seventieth


def test_channel_means(spark, folder):
    pictures = photos.read_pictures(spark, folder, drop_invalid=True)
    expected = {
        r.photo_file: np.frombuffer(r.data, np.uint8).reshape(-1, r.channels).mean(axis=0) for r in pictures.collect()
    }
    got = {r.photo_file: r.means for r in images.channel_means(pictures).collect()}
    assert got.keys() == expected.keys() and all(np.allclose(got[k], expected[k]) for k in got)


def test_empty_picture_table(spark, folder):
    none = photos.read_pictures(spark, folder).where("width > 99")
    assert images.channel_means(none).count() == 0 and images.letterbox_images(none, 4).count() == 0
    assert none.select(F.count("*")).head()[0] == 0


def test_pictures_of_one_row_group_are_spread(spark, tmp_path):
    spark.range(400).selectExpr("id AS p_partkey", "id % 50 + 1 AS p_size").coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    spark.range(400).selectExpr(
        "id AS vec_id", "array_repeat(CAST(id / 400 AS float), 64) AS embedding", "CAST(id % 2 AS int) AS label"
    ).coalesce(1).write.parquet(str(tmp_path / "embeddings.parquet"))
    for name in ("letterbox_sizes", "letterbox_images", "letterbox_resized", "image_channel_mean"):
        rows = QUERIES[name](spark, str(tmp_path)).withColumn("task", F.spark_partition_id())
        tasks = rows.groupBy("task").agg(F.count_distinct("photo_file").alias("n")).collect()
        # no task has much more than its share of the 400 pictures
        assert len(tasks) == 8 and sum(r.n for r in tasks) == 400 and max(r.n for r in tasks) <= 100, name


def test_weights_are_kept_once_and_stay():
    assert images.lanczos_weights(30, 7) is images.lanczos_weights(30, 7)
    with pytest.raises(ValueError, match="read-only"):
        images.lanczos_weights(30, 7)[0, 0] = 1
    # large matrices are not held
    assert images.lanczos_weights(4000, 299) is not images.lanczos_weights(4000, 299)
