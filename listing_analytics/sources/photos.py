"""Photo folders: file listing, encoded contents, decoded pictures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F


def with_stem(df: DataFrame, path: str = "path") -> DataFrame:
    """Add `photo_file`, `stem` and `ext` of a path; the extension keeps its dot."""
    name = F.regexp_extract(path, r"([^/]+)$", 1)
    ext = F.regexp_extract(name, r"(\.[^.]*)$", 1)
    return df.withColumns({
        "photo_file": name,
        "stem": F.left(name, F.length(name) - F.length(ext)),
        "ext": ext,
    })


def _files(spark: SparkSession, folder: str, extensions: Sequence[str] | None) -> DataFrame:
    reader = spark.read.format("binaryFile")
    if extensions:
        reader = reader.option("pathGlobFilter", "*{" + ",".join(extensions) + "}")
    return reader.load(folder)


def list_photos(spark: SparkSession, folder: str, extensions: Sequence[str] | None = None) -> DataFrame:
    """`path, photo_file, stem, ext` of the files in a folder; contents are not read."""
    return with_stem(_files(spark, folder, extensions).select("path"))


def read_photos(spark: SparkSession, folder: str, extensions: Sequence[str] | None = None) -> DataFrame:
    """The listing with each file's bytes as `content`."""
    return with_stem(_files(spark, folder, extensions).select("path", "content"))


def read_pictures(spark: SparkSession, folder: str, drop_invalid: bool = False) -> DataFrame:
    """Decoded pictures: `photo_file, stem, ext, width, height, channels, data`, pixels in BGR order."""
    pictures = (
        spark.read.format("image").option("dropInvalid", drop_invalid).load(folder)
        .select(
            F.col("image.origin").alias("path"), "image.width", "image.height",
            F.col("image.nChannels").alias("channels"), "image.data",
        )
    )
    return with_stem(pictures).drop("path")
