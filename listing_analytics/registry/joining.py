"""Joins and whole jobs."""

from pyspark.sql import Observation, functions as F

from listing_analytics.operators import filters, joins, projections
from listing_analytics.plans.photo_dataset import ATTRIBUTE_NAMES, Sample, labelled_photos, photo_dataset, write_with_report
from listing_analytics.plans.subset import SubsetSpec, business_extract, run_subset
from listing_analytics.registry import base
from listing_analytics.registry.base import (
    BUSINESS, CATEGORY, CHECKINS, PHOTOS, REVIEWS, RING_IDS, TIPS, TREE, query,
)
from listing_analytics.registry.labelling import ORDINAL_LIST
from listing_analytics.sinks.tables import text_safe
from listing_analytics.staging import stage_path

RING = f"SELECT * FROM ({BUSINESS}) AS b0 WHERE business_id IN ({RING_IDS})"


@query("photo_business_outer", f"""
    SELECT coalesce(p.business_id, b.business_id) AS business_id, photo_id, label, stars
    FROM ({PHOTOS}) AS p FULL JOIN ({RING}) AS b ON p.business_id = b.business_id""")
def photo_business_outer(spark, sf):
    business = filters.filter_categories(base.business(spark, sf), [CATEGORY]).select("business_id", "stars")
    return joins.attach_outer(base.photos(spark, sf), business, "business_id")


@query("photo_business_left", f"""
    SELECT p.business_id, photo_id, label, stars
    FROM ({PHOTOS}) AS p LEFT JOIN ({RING}) AS b ON p.business_id = b.business_id
    WHERE photo_id IS NOT NULL""")
def photo_business_left(spark, sf):
    business = filters.filter_categories(base.business(spark, sf), [CATEGORY]).select("business_id", "stars")
    return joins.attach(base.photos(spark, sf).where("photo_id is not null"), business, "business_id")


@query("photo_business_salted", f"""
    SELECT p.business_id, photo_id, label, stars
    FROM ({PHOTOS}) AS p LEFT JOIN ({RING}) AS b ON p.business_id = b.business_id""")
def photo_business_salted(spark, sf):
    business = filters.filter_categories(base.business(spark, sf), [CATEGORY]).select("business_id", "stars")
    return joins.attach(base.photos(spark, sf), business, "business_id", salts=8)


@query("truth_prediction_join", """
    SELECT d.doc_id, CAST(n_chars > 1000 AS INT) AS actual, quality AS predicted
    FROM documents AS d JOIN labels AS l ON d.doc_id = l.doc_id""")
def truth_prediction_join(spark, sf):
    truth = base.table(spark, sf, "documents").select("doc_id", (F.col("n_chars") > 1000).cast("int").alias("actual"))
    predicted = base.table(spark, sf, "labels").select("doc_id", F.col("quality").alias("predicted"))
    return joins.align(truth, predicted, "doc_id", unmatched="skip")


@query("truth_prediction_misaligned", """
    SELECT doc_id, 'truth' AS only_in FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
    UNION ALL
    SELECT doc_id, 'predicted' FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)""")
def truth_prediction_misaligned(spark, sf):
    return joins.misaligned(
        base.table(spark, sf, "documents").select("doc_id"), base.table(spark, sf, "labels").select("doc_id"), "doc_id"
    )


EXTENSIONS = [".jpg", ".png"]


def photo_files(spark, sf):
    """One file per photo, or two: statuses F and O have a .jpg, O and P a .png, with packed attributes."""
    orders = base.table(spark, sf, "orders")
    ext = F.when(F.col("o_orderstatus") == "F", F.array(F.lit(".jpg"))).when(
        F.col("o_orderstatus") == "P", F.array(F.lit(".png"))
    ).otherwise(F.array(F.lit(".png"), F.lit(".jpg")))
    files = orders.select(
        base.text("o_orderkey").alias("stem"), F.explode(ext).alias("ext"),
        (F.col("o_custkey") % 400 + 200).alias("w"), (F.col("o_orderkey") % 300 + 100).alias("h"),
    )
    jpg = F.col("ext") == ".jpg"
    return files.select(
        "stem", "ext",
        F.concat_ws(
            ",", F.concat("stem", "ext"), F.when(jpg, "JPEG").otherwise("PNG"), F.col("w").cast("string"),
            F.col("h").cast("string"), F.when(jpg, "RGB").otherwise("P"),
        ).alias("attributes"),
    )


@query("photo_business_hot", f"""
    SELECT p.business_id, photo_id, label, stars
    FROM ({PHOTOS}) AS p LEFT JOIN ({RING}) AS b ON p.business_id = b.business_id""")
def photo_business_hot(spark, sf):
    """Only the photos of customers with very many orders are spread."""
    business = filters.filter_categories(base.business(spark, sf), [CATEGORY]).select("business_id", "stars")
    return joins.attach_hot(base.photos(spark, sf), business, "business_id", "photo_id")


FILES = """
    SELECT CAST(o_orderkey AS VARCHAR) AS stem, o_orderstatus <> 'P' AS jpg,
           CAST(o_custkey % 400 + 200 AS INT) AS width, CAST(o_orderkey % 300 + 100 AS INT) AS height
    FROM orders"""


@query("photo_file_match", f"""
    SELECT photo_id, stem || CASE WHEN jpg THEN '.jpg' ELSE '.png' END AS photo_file
    FROM ({PHOTOS}) AS p JOIN ({FILES}) AS f ON photo_id = stem""")
def photo_file_match(spark, sf):
    files = photo_files(spark, sf).select("stem", "ext", F.concat("stem", "ext").alias("photo_file"))
    return joins.match_files(base.photos(spark, sf), files, EXTENSIONS).select("photo_id", "photo_file")


@query("photo_dataset", f"""
    WITH b AS ({RING}), span AS (SELECT min(stars) AS low, max(stars) AS high FROM b),
         p AS (SELECT * FROM ({PHOTOS}) AS p0 WHERE business_id IN ({RING_IDS})),
         rated AS (
            SELECT business_id, stars, replace(CAST(stars AS VARCHAR), '.', '_') AS stars_cat,
                   CAST(to_json({ORDINAL_LIST}) AS VARCHAR) AS stars_ord, CAST(ceil(stars * 2) AS INT) AS stars_num
            FROM b, span)
    SELECT p.business_id, stars, stars_cat, stars_ord, stars_num, photo_id,
           stem || CASE WHEN jpg THEN '.jpg' ELSE '.png' END AS photo_file,
           CASE WHEN jpg THEN 'JPEG' ELSE 'PNG' END AS format, width, height,
           CASE WHEN jpg THEN 'RGB' ELSE 'P' END AS mode
    FROM p LEFT JOIN rated AS r ON p.business_id = r.business_id JOIN ({FILES}) AS f ON photo_id = stem""")
def photo_dataset_query(spark, sf):
    files = projections.split_to_columns(
        photo_files(spark, sf), "attributes", ATTRIBUTE_NAMES, {"width": "int", "height": "int"}
    ).drop("attributes")
    dataset = photo_dataset(
        base.business(spark, sf), base.photos(spark, sf), files, EXTENSIONS, ids=base.ring_ids(spark, sf)
    )
    return text_safe(dataset)


@query("photo_dataset_report", f"""
    WITH p AS (SELECT * FROM ({PHOTOS}) AS p0 WHERE photo_id NOT LIKE '%7' AND business_id IN ({RING_IDS})),
         d AS (SELECT f.* FROM p JOIN ({FILES}) AS f ON photo_id = stem)
    SELECT (SELECT count(*) FROM ({PHOTOS}) AS p1) AS loaded, (SELECT count(*) FROM ({PHOTOS}) AS p2 WHERE photo_id LIKE '%7') AS dropped,
           count(*) AS written, min(width) AS min_width, max(width) AS max_width, min(height) AS min_height,
           max(height) AS max_height, count(DISTINCT width) AS widths, count(DISTINCT height) AS heights
    FROM d""")
def photo_dataset_report(spark, sf):
    """Photos whose id ends in 7 have none; the counts come from the job that writes the dataset, the rest from what it wrote."""
    files = projections.split_to_columns(
        photo_files(spark, sf), "attributes", ATTRIBUTE_NAMES, {"width": "int", "height": "int"}
    ).drop("attributes")
    photos = base.photos(spark, sf).withColumn("photo_id", F.when(~F.col("photo_id").endswith("7"), F.col("photo_id")))
    counts = Observation()
    dataset = photo_dataset(base.business(spark, sf), photos, files, EXTENSIONS, ids=base.ring_ids(spark, sf), counts=counts)
    report = write_with_report(dataset, counts, stage_path(spark, "dataset"))
    spans = report.profile["range"]
    return spans.select(
        F.lit(report.loaded).cast("bigint").alias("loaded"), F.lit(report.dropped).cast("bigint").alias("dropped"),
        F.lit(report.written).cast("bigint").alias("written"), *[F.col(f"{f}_{c}") for c in ("width", "height") for f in ("min", "max")],
        F.lit(report.profile["width"].count()).cast("bigint").alias("widths"),
        F.lit(report.profile["height"].count()).cast("bigint").alias("heights"),
    )


@query("photo_dataset_sampled", f"""
    WITH p AS (SELECT * FROM ({PHOTOS}) AS p0 WHERE business_id IN ({RING_IDS})),
         k AS (SELECT business_id, row_number() OVER (ORDER BY md5(business_id || '|1'), business_id) AS r,
                      count(*) OVER () AS n
               FROM (SELECT DISTINCT business_id FROM p))
    SELECT photo_id, p.business_id, stars
    FROM p LEFT JOIN ({RING}) AS b ON p.business_id = b.business_id
    WHERE p.business_id IN (SELECT business_id FROM k WHERE r <= CAST(round_even(0.5 * n, 0) AS BIGINT))""")
def photo_dataset_sampled(spark, sf):
    return labelled_photos(
        base.business(spark, sf), base.photos(spark, sf), ids=base.ring_ids(spark, sf),
        sample=Sample(0.5, "business_id"),
    ).select("photo_id", "business_id", "stars")


@query("business_extract", f"""
    SELECT business_id, categories, stars, coalesce(nullif(brand, 'Brand#4'), '') AS brand,
           kind AS "attributes.kind", stars >= 4 AS "attributes.good", brand AS "hours.monday.open"
    FROM ({BUSINESS}) AS b
    WHERE list_has_any(list_transform(string_split(categories, ','), lambda x: trim(x)), ['ring', 'bolt'])
      AND regexp_matches(kind, '^[A-M]')""")
def business_extract_query(spark, sf):
    wide = base.business(spark, sf).select(
        "business_id", "categories", "stars",
        F.nullif("brand", F.lit("Brand#4")).alias("brand"),
        F.lit("{}").alias("attributes"),
        F.col("kind").alias("attributes.kind"),
        (F.col("stars") >= 4).alias("attributes.good"),
        F.lit("{}").alias("hours"),
        F.lit("{}").alias("hours.monday"),
        F.col("brand").alias("hours.monday.open"),
        F.lit(1).alias("attributes.HairStyle"),
    )
    spec = SubsetSpec(rules=(filters.RegexRule("biz", "attributes.kind", "^[A-M]"),), drop="attributes.Hair")
    return business_extract(wide, spec, categories=["ring", "bolt"])


# Customers in the role of categories of the tree: the children of a segment select the businesses.
SEGMENT = "MACHINERY"

SUBSET_BUSINESS = """
    SELECT CAST(o_orderkey AS VARCHAR) AS business_id,
           lower(c_name) || ', ' || lower(o_orderpriority) AS categories, o_orderstatus AS status
    FROM orders JOIN customer ON o_custkey = c_custkey"""


@query("subset_run", f"""
    WITH titles AS (
            SELECT title FROM ({TREE}) AS t
            WHERE alias = '{SEGMENT}' OR coalesce(list_contains(parent_aliases, '{SEGMENT}'), false)),
         b AS (
            SELECT * FROM ({SUBSET_BUSINESS}) AS b0
            WHERE trim(split_part(categories, ',', 1)) IN (SELECT title FROM titles)
               OR trim(split_part(categories, ',', 2)) IN (SELECT title FROM titles)),
         ids AS (SELECT business_id FROM b WHERE regexp_matches(status, 'O|P')),
         records AS (
            SELECT 'review' AS entity, business_id FROM ({REVIEWS}) AS r
            UNION ALL SELECT 'tip', business_id FROM ({TIPS}) AS t
            UNION ALL SELECT 'checkin', business_id FROM ({CHECKINS}) AS c
            UNION ALL SELECT 'photo', business_id FROM ({PHOTOS}) AS p)
    SELECT entity, business_id, count(*) AS n FROM (
        SELECT * FROM records WHERE business_id IN (SELECT business_id FROM ids)
        UNION ALL SELECT 'business', business_id FROM ids)
    GROUP BY entity, business_id""")
def subset_run(spark, sf):
    orders, customer = base.table(spark, sf, "orders"), base.table(spark, sf, "customer")
    business = orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        base.text("o_orderkey").alias("business_id"),
        F.concat_ws(", ", F.lower("c_name"), F.lower("o_orderpriority")).alias("categories"),
        F.col("o_orderstatus").alias("status"),
    )
    subset = run_subset(
        SubsetSpec(parent=SEGMENT, rules=(filters.RegexRule("biz", "status", "O|P"),)),
        business=business,
        tree=base.tree(spark, sf),
        review=base.reviews(spark, sf),
        tip=base.tips(spark, sf),
        checkin=base.checkins(spark, sf),
        photo=base.photos(spark, sf),
    )
    out = subset.ids.select(F.lit("business").alias("entity"), "business_id")
    for entity, records in subset.records.items():
        out = out.unionByName(records.select(F.lit(entity).alias("entity"), "business_id"))
    return out.groupBy("entity", "business_id").agg(F.count(F.lit(1)).alias("n"))
