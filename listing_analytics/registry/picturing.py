"""Photo attributes and pixel jobs, on pictures that Spark derives from the given tables."""

from pyspark.sql import functions as F

from listing_analytics.operators import images
from listing_analytics.registry import base
from listing_analytics.registry.base import query

SIZES = "SELECT p_partkey, 100 + p_size * 13 AS width, CAST(80 + p_partkey % 500 AS INT) AS height FROM part"


def sizes(spark, sf):
    return base.table(spark, sf, "part").select(
        "p_partkey", (F.col("p_size") * 13 + 100).alias("width"), (F.col("p_partkey") % 500 + 80).cast("int").alias("height")
    )


def _plan(ratio: str, wide: int, high: int) -> str:
    return f"""
    WITH s AS (SELECT *, {ratio} AS ratio FROM ({SIZES}) AS s0),
         n AS (SELECT *, CAST(trunc(width * ratio) AS INT) AS new_width, CAST(trunc(height * ratio) AS INT) AS new_height
               FROM s)
    SELECT p_partkey, new_width, new_height, CAST(({wide} - new_width) // 2 AS INT) AS "left",
           CAST(({high} - new_height) // 2 AS INT) AS top
    FROM n"""


@query("letterbox_plan", _plan("299.0::DOUBLE / greatest(width, height)", 299, 299))
def letterbox_plan(spark, sf):
    return images.letterbox_plan(sizes(spark, sf), 299).drop("width", "height")


@query("letterbox_plan_box", _plan("least(150.0::DOUBLE / width, 100.0::DOUBLE / height)", 150, 100))
def letterbox_plan_box(spark, sf):
    return images.letterbox_plan(sizes(spark, sf), (150, 100)).drop("width", "height")


@query("image_attributes", f"""
    SELECT s.p_partkey, CASE p_type WHEN 'ECONOMY' THEN 'JPEG' WHEN 'PROMO' THEN 'GIF' WHEN 'SMALL' THEN 'BMP'
                            ELSE 'PNG' END AS format,
           width, height,
           CASE p_type WHEN 'ECONOMY' THEN 'RGB' WHEN 'PROMO' THEN 'P' WHEN 'SMALL' THEN 'RGB' WHEN 'LARGE' THEN 'L'
                WHEN 'MEDIUM' THEN 'RGBA' ELSE 'RGB' END AS mode
    FROM ({SIZES}) AS s JOIN part USING (p_partkey)""")
def image_attributes(spark, sf):
    """Header bytes of a picture per part, the format by its type, read back by the header reader."""
    part = base.table(spark, sf, "part")
    width, height = F.col("p_size") * 13 + 100, F.col("p_partkey") % 500 + 80
    wide, high = (F.lpad(F.hex(side.cast("bigint")), 4, "0") for side in (width, height))
    little_wide, little_high = (F.concat(F.substring(side, 3, 2), F.substring(side, 1, 2)) for side in (wide, high))

    def png(colour: str):
        return F.concat(
            F.lit("89504E470D0A1A0A0000000D494844520000"), wide, F.lit("0000"), high, F.lit(f"08{colour}00000000000000")
        )

    jpeg = F.concat(
        F.lit("FFD8FFE000104A46494600010100000100010000FFFE00044A4BFFC0001108"), high, wide,
        F.lit("03012200021101031101"),
    )
    gif = F.concat(F.lit("474946383961"), little_wide, little_high, F.lit("000000"))
    bmp = F.concat(
        F.lit("424D36000000000000003600000028000000"), little_wide, F.lit("0000"), little_high,
        F.lit("000001001800000000000000"),
    )
    header = (
        F.when(F.col("p_type") == "ECONOMY", jpeg).when(F.col("p_type") == "PROMO", gif)
        .when(F.col("p_type") == "SMALL", bmp).when(F.col("p_type") == "LARGE", png("00"))
        .when(F.col("p_type") == "MEDIUM", png("06")).otherwise(png("02"))
    )
    return images.image_attributes(part.select("p_partkey", F.unhex(header).alias("content")))


# A vector's 64 positions as pixels: values -1..1 become 0..255. Even labels make a 4 x 4 picture of four
# channels, odd ones an 8 x 8 grey picture.
PIXEL = "CAST(floor((x + 1) * 127.5::DOUBLE) AS INT)"


def pictures(spark, sf, grey=False):
    colour = F.lit(False) if grey else F.col("label") % 2 == 0
    data = F.unhex(F.array_join(
        F.transform("embedding", lambda x: F.lpad(F.hex(F.floor((x + 1) * 127.5).cast("bigint")), 2, "0")), ""
    ))
    side = F.when(colour, 4).otherwise(8)
    return base.spread(base.vectors(spark, sf)).select(
        base.text("vec_id").alias("photo_file"), side.alias("width"), side.alias("height"),
        F.when(colour, 4).otherwise(1).alias("channels"), data.alias("data"),
    )


PIXELS = f"""
    SELECT CAST(vec_id AS VARCHAR) AS photo_file, label % 2 = 0 AS colour, position, {PIXEL} AS v
    FROM (SELECT vec_id, label, unnest(range(len(embedding))) AS position, unnest(embedding::DOUBLE[]) AS x
          FROM embeddings)"""


@query("image_channel_mean", f"""
    SELECT photo_file, CAST(CASE WHEN colour THEN position % 4 ELSE 0 END AS INT) AS channel, round(avg(v), 6) AS mean
    FROM ({PIXELS}) AS p GROUP BY photo_file, CASE WHEN colour THEN position % 4 ELSE 0 END""")
def image_channel_mean(spark, sf):
    return images.channel_means(pictures(spark, sf)).select(
        "photo_file", F.posexplode("means").alias("channel", "mean")
    ).select("photo_file", "channel", F.round("mean", 6).alias("mean"))


@query("letterbox_images", f"""
    WITH g AS (
        SELECT photo_file, position // 8 AS y, position % 8 + 4 AS x, unnest([v, v, v]) AS v, unnest([0, 1, 2]) AS c
        FROM ({PIXELS}) AS p),
      canvas AS (
        SELECT photo_file, unnest(range(16 * 8 * 3)) AS place FROM (SELECT DISTINCT photo_file FROM g))
    SELECT k.photo_file, 16 AS width, 8 AS height,
           string_agg(printf('%02X', coalesce(v, 0)), '' ORDER BY place) AS pixels
    FROM canvas AS k LEFT JOIN g ON g.photo_file = k.photo_file AND place = (y * 16 + x) * 3 + c
    GROUP BY k.photo_file""")
def letterbox_images(spark, sf):
    """All vectors as grey pictures on a wider canvas of their own height: they keep their size, so every pixel is known."""
    boxed = images.letterbox_images(pictures(spark, sf, grey=True), (16, 8))
    return boxed.select("photo_file", "width", "height", F.hex("data").alias("pixels"))


@query("letterbox_resized")
def letterbox_resized(spark, sf):
    return images.letterbox_images(pictures(spark, sf), 6).select(
        "photo_file", "width", "height", "channels", F.hex("data").alias("pixels")
    )


# Every part as a flat picture; a colour says whose it is.
FLAT = """
    SELECT CAST(p_partkey AS VARCHAR) AS photo_file, CAST(1 + p_size AS INT) AS width, CAST(1 + p_partkey % 37 AS INT) AS height,
           printf('%02X%02X%02X', CAST(p_partkey % 256 AS INT), CAST(p_size AS INT), 255) AS colour
    FROM part"""

SET_SIZES = (6, (9, 4), 25)


def flat_pictures(spark, sf):
    width, height = (F.col("p_size") + 1).cast("int"), (F.col("p_partkey") % 37 + 1).cast("int")
    pixel = F.concat(*[F.lpad(F.hex(c.cast("bigint")), 2, "0") for c in (F.col("p_partkey") % 256, F.col("p_size"), F.lit(255))])
    return base.spread(base.table(spark, sf, "part").select("p_partkey", "p_size")).select(
        base.text("p_partkey").alias("photo_file"), width.alias("width"), height.alias("height"), F.lit(3).alias("channels"),
        F.unhex(F.repeat(pixel, width * height)).alias("data"),
    )


def _flat_set(size) -> str:
    wide, high = size if isinstance(size, tuple) else (size, size)
    ratio = f"least({wide}.0::DOUBLE / width, {high}.0::DOUBLE / height)" if isinstance(size, tuple) else f"{size}.0::DOUBLE / greatest(width, height)"
    return f"""
    SELECT photo_file, '{wide}x{high}' AS size, {wide} AS width, {high} AS height,
           repeat(blank, top) || repeat(repeat('000000', "left") || repeat(colour, w) || repeat('000000', {wide} - w - "left"), h)
           || repeat(blank, {high} - h - top) AS pixels
    FROM (SELECT photo_file, colour, blank, if(w = 0, 0, h) AS h, if(h = 0, 0, w) AS w, ({wide} - w) // 2 AS "left", ({high} - h) // 2 AS top
          FROM (SELECT *, CAST(trunc(width * ({ratio})) AS INT) AS w, CAST(trunc(height * ({ratio})) AS INT) AS h, repeat('000000', {wide}) AS blank
                FROM ({FLAT}) AS f))"""


@query("letterbox_sizes", " UNION ALL ".join(map(_flat_set, SET_SIZES)))
def letterbox_sizes(spark, sf):
    """Flat pictures in three sizes from one pass: whatever is resampled, every pixel is known."""
    boxed = images.letterbox_sets(flat_pictures(spark, sf), SET_SIZES)
    return boxed.select("photo_file", "size", "width", "height", F.hex("data").alias("pixels"))
