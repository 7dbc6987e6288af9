"""Photo attributes from encoded bytes, and pixel jobs on decoded pictures.

A picture is a row `width, height, channels, data` with its pixels in BGR(A) order, as Spark's
image source decodes it.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from listing_analytics.functions.sizes import canvas, letterbox
from listing_analytics.sources.tables import quoted

ATTRIBUTES = T.StructType([
    T.StructField("format", T.StringType()),
    T.StructField("width", T.IntegerType()),
    T.StructField("height", T.IntegerType()),
    T.StructField("mode", T.StringType()),
])

PIXELS = T.StructType([
    T.StructField("photo_file", T.StringType()),
    T.StructField("width", T.IntegerType()),
    T.StructField("height", T.IntegerType()),
    T.StructField("channels", T.IntegerType()),
    T.StructField("data", T.BinaryType()),
])

SETS = T.StructType([PIXELS["photo_file"], T.StructField("size", T.StringType()), *PIXELS.fields[1:]])

# Bytes of finished canvases that a task holds before it hands them on.
PIECE_BYTES = 16 << 20

# Picture modes by the number of JPEG components and by the PNG colour type.
JPEG_MODES = {1: "L", 3: "RGB", 4: "CMYK"}
PNG_MODES = {0: "L", 2: "RGB", 3: "P", 4: "LA", 6: "RGBA"}

# Bytes of a file that are looked at first.
HEADER_BYTES = 65536

# Reach of the Lanczos kernel in source pixels.
LANCZOS_REACH = 3

# Entries of the largest matrix of Lanczos weights that a worker keeps (32 KB, 64 MB for all it keeps).
KEPT_WEIGHTS = 4096


def _jpeg_header(content: bytes) -> tuple | None:
    """Walk the segments up to the frame header."""
    at = 2
    while at + 9 < len(content):
        if content[at] != 0xFF:
            return None
        marker = content[at + 1]
        if marker == 0xFF:
            at += 1
        elif 0xC0 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
            height, width, components = struct.unpack(">HHB", content[at + 5:at + 10])
            return "JPEG", width, height, JPEG_MODES.get(components)
        else:
            at += 2 + struct.unpack(">H", content[at + 2:at + 4])[0]
    return None


def picture_header(content: bytes | None) -> tuple | None:
    """`format, width, height, mode` of an encoded picture; None when it is not a known one."""
    if not content:
        return None
    if content[:2] == b"\xff\xd8":
        return _jpeg_header(content)
    if content[:8] == b"\x89PNG\r\n\x1a\n" and len(content) >= 26:
        width, height, depth, colour = struct.unpack(">IIBB", content[16:26])
        return "PNG", width, height, "1" if (depth, colour) == (1, 0) else PNG_MODES.get(colour)
    if content[:4] == b"GIF8" and len(content) >= 10:
        return "GIF", *struct.unpack("<HH", content[6:10]), "P"
    if content[:2] == b"BM" and len(content) >= 30:
        width, height, _, depth = struct.unpack("<iiHH", content[18:30])
        return "BMP", width, abs(height), "RGB" if depth > 8 else "1" if depth == 1 else "P"
    return None


def image_attributes(df: DataFrame, content: str = "content", unreadable: str = "error") -> DataFrame:
    """Replace `content` by `format, width, height, mode`, read from the file header alone.

    An unreadable picture raises an error when its row is read (`unreadable="error"`), is dropped
    (`"drop"`) or keeps null attributes (`"keep"`).
    """
    if unreadable not in ("error", "drop", "keep"):
        raise ValueError(f"unreadable must be 'error', 'drop' or 'keep': {unreadable!r}")

    @F.pandas_udf(ATTRIBUTES)
    def attributes(contents: pd.Series) -> pd.DataFrame:
        rows = [picture_header(c) or (None,) * 4 for c in contents]
        table = pd.DataFrame(rows, columns=ATTRIBUTES.names)
        return table.astype({"width": "Int32", "height": "Int32"})

    kept = [quoted(c) for c in df.columns if c != content]
    whole = F.col(quoted(content))
    # nearly every header ends within its first bytes; only the others are handed over whole
    read = (
        df.withColumn("_start", attributes(F.substring(whole, 1, HEADER_BYTES)))
        .withColumn("_rest", attributes(F.when(F.col("_start.format").isNull(), whole)))
        .select(*kept, *[F.coalesce(f"_start.{n}", f"_rest.{n}").alias(n) for n in ATTRIBUTES.names])
    )
    if unreadable == "drop":
        return read.where(F.col("format").isNotNull())
    return require_readable(read) if unreadable == "error" else read


def require_readable(df: DataFrame) -> DataFrame:
    """Raise an error when a row without a picture format is read."""
    unknown = F.when(F.col("format").isNull(), F.raise_error(F.lit("not a known picture format")))
    return df.withColumn("format", unknown.otherwise(F.col("format")))


def letterbox_plan(df: DataFrame, size: int | tuple[int, int], width: str = "width", height: str = "height") -> DataFrame:
    """Add `new_width, new_height, left, top` of each picture on a canvas of `size`."""
    box = letterbox(F.col(quoted(width)), F.col(quoted(height)), size)
    return df.withColumns(box._asdict())


def _pixels(data: bytes | pa.Buffer, height: int, width: int, channels: int) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(height, width, channels)


def lanczos_weights(old: int, new: int) -> np.ndarray:
    """The new x old matrix that resamples a line of pixels; a worker keeps small ones."""
    return _small_weights(old, new) if old * new <= KEPT_WEIGHTS else _weights(old, new)


def _weights(old: int, new: int) -> np.ndarray:
    step = old / new
    stretch = max(step, 1.0)
    centres = (np.arange(new) + 0.5) * step
    distance = (np.arange(old) + 0.5 - centres[:, None]) / stretch
    weights = np.where(np.abs(distance) < LANCZOS_REACH, np.sinc(distance) * np.sinc(distance / LANCZOS_REACH), 0.0)
    return weights / weights.sum(axis=1, keepdims=True)


@lru_cache(maxsize=2048)
def _small_weights(old: int, new: int) -> np.ndarray:
    weights = _weights(old, new)
    weights.flags.writeable = False
    return weights


def _resample(pixels: np.ndarray, width: int, height: int) -> np.ndarray:
    across = np.einsum("ij,hjc->hic", lanczos_weights(pixels.shape[1], width), pixels.astype(float))
    across = np.clip(np.rint(across), 0, 255)
    down = np.einsum("ij,jwc->iwc", lanczos_weights(pixels.shape[0], height), across)
    return np.clip(np.rint(down), 0, 255).astype(np.uint8)


def letterbox_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pictures with their `boxes` to rows of `SETS`, in pieces of `PIECE_BYTES`."""
    rows, held = [], 0

    def piece() -> pa.RecordBatch:
        columns = list(zip(*rows)) or [()] * 6
        kinds = (pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], SETS.names)

    for batch in batches:
        names, widths, heights, channels = (batch.column(c).to_pylist() for c in ("photo_file", "width", "height", "channels"))
        for i, (data, boxes) in enumerate(zip(batch.column("data"), batch.column("boxes").to_pylist())):
            pixels = _pixels(data.as_buffer(), heights[i], widths[i], channels[i])
            colour = np.repeat(pixels[:, :, :1], 3, axis=2) if channels[i] < 3 else pixels[:, :, :3]
            for box in boxes:
                wide, high = box["wide"], box["high"]
                if rows and held + 3 * wide * high > PIECE_BYTES:
                    yield piece()
                    rows, held = [], 0
                out = np.zeros((high, wide, 3), np.uint8)
                if box["new_width"] > 0 and box["new_height"] > 0:
                    out[box["top"]:box["top"] + box["new_height"], box["left"]:box["left"] + box["new_width"]] = _resample(
                        colour, box["new_width"], box["new_height"]
                    )
                rows.append((names[i], f"{wide}x{high}", wide, high, 3, out.tobytes()))
                held += out.size
    yield piece()


def letterbox_sets(pictures: DataFrame, sizes: Sequence[int | tuple[int, int]]) -> DataFrame:
    """`photo_file, size, width, height, channels, data`: each picture on a black three-channel canvas of each size.

    `size` is the canvas as text, such as `299x299`. All sizes come from one pass over the decoded pictures, and a task
    holds `PIECE_BYTES` of finished canvases at most, or one. Grey pictures are spread over the three channels and transparency
    is dropped. A side that would shrink below one pixel leaves the canvas black.
    """
    if not sizes:
        raise ValueError("at least one size is needed")
    width, height = F.col("width"), F.col("height")
    boxes = [
        F.struct(F.lit(wide).alias("wide"), F.lit(high).alias("high"), *[c.alias(n) for n, c in letterbox(width, height, size)._asdict().items()])
        for size in sizes for wide, high in [canvas(size)]
    ]
    planned = (
        pictures.select("photo_file", "width", "height", "channels", "data").where("width > 0 and height > 0")
        .withColumn("boxes", F.array(*boxes))
    )
    return planned.mapInArrow(letterbox_pieces, SETS)


def letterbox_images(pictures: DataFrame, size: int | tuple[int, int]) -> DataFrame:
    """`letterbox_sets` for one size, without its name."""
    return letterbox_sets(pictures, [size]).drop("size")


def png(width: int, height: int, channels: int, data: bytes) -> bytes:
    """The pixels of a picture (BGR(A) order, or grey) as a PNG file."""
    pixels = np.frombuffer(data, np.uint8).reshape(height, width, channels)
    if channels >= 3:
        pixels = pixels[:, :, [2, 1, 0, 3][:channels]]
    lines = np.zeros((height, 1 + width * channels), np.uint8)  # each line behind its filter, none
    lines[:, 1:] = pixels.reshape(height, -1)
    kind = next(k for k, mode in PNG_MODES.items() if mode == {1: "L", 2: "LA", 3: "RGB", 4: "RGBA"}[channels])

    def chunk(name: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + name + body + struct.pack(">I", zlib.crc32(name + body))

    header = struct.pack(">IIBBBBB", width, height, 8, kind, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", header) + chunk(b"IDAT", zlib.compress(lines.tobytes())) + chunk(b"IEND", b"")


def as_png(pictures: DataFrame) -> DataFrame:
    """Replace `width, height, channels, data` by the encoded file as `content`; a file's extension becomes `.png`."""

    @F.pandas_udf("binary")
    def encode(width: pd.Series, height: pd.Series, channels: pd.Series, data: pd.Series) -> pd.Series:
        return pd.Series([png(*row) for row in zip(width, height, channels, data)], dtype=object)

    kept = [F.col(quoted(c)) for c in pictures.columns if c not in ("photo_file", "width", "height", "channels", "data")]
    return pictures.select(
        F.concat(F.regexp_replace("photo_file", r"\.[^.]*$", ""), F.lit(".png")).alias("photo_file"), *kept,
        encode("width", "height", "channels", "data").alias("content"),
    )


def channel_means(pictures: DataFrame, key: str = "photo_file") -> DataFrame:
    """`key, means`: the mean of each channel over all pixels, in the stored channel order."""
    schema = T.StructType([pictures.schema[key], T.StructField("means", T.ArrayType(T.DoubleType()))])

    def average(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            means = [_pixels(r.data, r.height, r.width, r.channels).mean(axis=(0, 1)).tolist() for r in batch.itertuples()]
            yield pd.DataFrame({key: batch[key], "means": pd.Series(means, index=batch.index, dtype=object)})

    needed = pictures.select(key, "width", "height", "channels", "data").where("width > 0 and height > 0")
    return needed.mapInPandas(average, schema)
