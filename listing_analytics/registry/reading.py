"""Sources, sinks and projections."""

from pyspark.sql import functions as F

from listing_analytics.functions import text
from listing_analytics.operators import projections
from listing_analytics.registry import base
from listing_analytics.registry.base import BUSINESS, query
from listing_analytics.sinks.tables import class_map_json, text_safe, write_csv
from listing_analytics.sources import documents, lists, tables
from listing_analytics.staging import stage_path


@query("category_scan", """
    SELECT c_name AS alias, lower(c_name) AS title, c_mktsegment AS parents FROM customer
    UNION ALL
    SELECT c_mktsegment, lower(c_mktsegment), NULL FROM customer""")
def category_scan(spark, sf):
    node = F.struct(
        F.col("c_name").alias("alias"), F.lower("c_name").alias("title"), F.array("c_mktsegment").alias("parent_aliases")
    )
    root = F.struct(
        F.col("c_mktsegment").alias("alias"), F.lower("c_mktsegment").alias("title"),
        F.lit(None).cast("array<string>").alias("parent_aliases"),
    )
    texts = base.table(spark, sf, "customer").select(
        F.to_json(F.struct(F.array(node, root).alias("categories"))).alias("value")
    )
    return documents.categories_from_json(texts).select(
        "alias", "title", F.array_join("parent_aliases", ",").alias("parents")
    )


@query("csv_round_trip", "SELECT CAST(doc_id AS VARCHAR) AS business_id, text, lang FROM documents")
def csv_round_trip(spark, sf):
    path = stage_path(spark, "csv")
    written = base.table(spark, sf, "documents").select(F.col("doc_id").alias("business_id"), "text", "lang")
    write_csv(written, path)
    return tables.read_entity(spark, path, "review")


@query("typed_scan", """
    SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_size, p_retailprice FROM part""")
def typed_scan(spark, sf):
    part = base.table(spark, sf, "part")
    cells = part.select([base.text(c).alias(c) for c in ("p_partkey", "p_name", "p_size", "p_retailprice")])
    return tables.apply_types(cells, {"p_size": "int", "p_retailprice": "double"})


@query("nullable_bool", """
    SELECT d.doc_id, CASE WHEN quality IS NOT NULL THEN true END AS flag, quality = 1 AS strict_flag
    FROM documents AS d LEFT JOIN labels AS l ON d.doc_id = l.doc_id""")
def nullable_bool(spark, sf):
    labels = base.table(spark, sf, "labels")
    cell = F.coalesce(F.initcap((F.col("quality") == 1).cast("string")), F.lit(""))
    joined = base.table(spark, sf, "documents").select("doc_id").join(labels, "doc_id", "left")
    return joined.select(
        "doc_id",
        text.nullable_bool(cell).alias("flag"),
        text.nullable_bool(cell, strict=True).alias("strict_flag"),
    )


@query("line_list", r"""
    SELECT regexp_replace(line, '[\s\p{Z}\x0b\x{85}\x1c-\x1f]+$', '') AS value
    FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM conversations)""")
def line_list(spark, sf):
    lines = base.table(spark, sf, "conversations").select(F.explode(F.split("text", "\n")).alias("line"))
    return lists.clean_lines(lines.select(F.concat("line", F.lit(" \t ")).alias("line")), "line")


@query("json_list_parse", """
    SELECT p_partkey, (p_size % 3)::INT AS t0, (p_size % 2)::INT AS t1, 1 AS t2, 3::BIGINT AS items FROM part""")
def json_list_parse(spark, sf):
    cells = base.table(spark, sf, "part").select(
        "p_partkey",
        F.concat(F.lit("["), F.col("p_size") % 3, F.lit(", "), F.col("p_size") % 2, F.lit(", 1]")).alias("stars_ord"),
    )
    parsed = cells.withColumn("stars_ord", F.from_json("stars_ord", "array<int>"))
    return projections.expand_list(parsed, "stars_ord").select(
        "p_partkey", "t0", "t1", "t2", F.size("stars_ord").cast("bigint").alias("items")
    )


@query("json_list_format", """
    SELECT p_partkey, CAST(to_json([p_size % 3, p_size % 2, 1]) AS VARCHAR) AS stars_ord FROM part""")
def json_list_format(spark, sf):
    return text_safe(base.table(spark, sf, "part").select(
        "p_partkey", F.array(F.col("p_size") % 3, F.col("p_size") % 2, F.lit(1)).alias("stars_ord")
    ))


@query("json_flatten", """
    SELECT event_id, event_type AS "event.type", CAST(json_extract_string(props, '$.k') AS BIGINT) AS "event.props.k",
           value AS "event.value"
    FROM events""")
def json_flatten(spark, sf):
    nested = base.table(spark, sf, "events").select(
        "event_id",
        F.struct(
            F.col("event_type").alias("type"),
            F.from_json("props", "struct<k:bigint>").alias("props"),
            "value",
        ).alias("event"),
    )
    return documents.flatten_struct(nested)


@query("class_map_decode", f"""
    SELECT CAST(business_id AS INT) AS class_idx, replace(CAST(stars AS VARCHAR), '.', '_') AS cat, stars
    FROM ({BUSINESS}) AS b""")
def class_map_decode(spark, sf):
    maps = base.business(spark, sf).select(F.to_json(
        F.create_map("business_id", F.replace(base.text("stars"), F.lit("."), F.lit("_")))
    ).alias("value"))
    return documents.class_map_entries(maps)


@query("class_map_encode", f"""
    WITH classes AS (
        SELECT cat, row_number() OVER (ORDER BY cat) - 1 AS idx
        FROM (SELECT DISTINCT replace(CAST(stars AS VARCHAR), '.', '_') AS cat FROM ({BUSINESS}) AS b))
    SELECT '{{' || string_agg('"' || idx || '":"' || cat || '"', ',' ORDER BY idx) || '}}' AS value FROM classes""")
def class_map_encode(spark, sf):
    labelled = projections.add_labels(base.business(spark, sf))
    return class_map_json(projections.class_map(labelled, "stars_cat"))


@query("map_invert", """
    SELECT event_id, event_type AS type_value, 'type' AS type_key, 'user' AS user_key FROM events""")
def map_invert(spark, sf):
    inverted = base.table(spark, sf, "events").select(
        "event_id", "event_type", "user_id",
        text.invert_map(F.create_map(F.lit("type"), "event_type", F.lit("user"), base.text("user_id"))).alias("m"),
    )
    return inverted.select(
        "event_id",
        F.get(F.map_keys("m"), F.lit(0)).alias("type_value"),
        F.try_element_at("m", F.col("event_type")).alias("type_key"),
        F.try_element_at("m", base.text("user_id")).alias("user_key"),
    )


@query("run_log_params", """
    SELECT event_id, 'k=' || json_extract_string(props, '$.k') || ';type=' || event_type || ';user=' || user_id AS params
    FROM events""")
def run_log_params(spark, sf):
    params = F.map_concat(
        F.create_map(F.lit("user"), base.text("user_id"), F.lit("type"), F.col("event_type")),
        F.from_json("props", "map<string,string>"),
    )
    return base.table(spark, sf, "events").select("event_id", text.params_text(params).alias("params"))


@query("drop_columns_regex", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def drop_columns_regex(spark, sf):
    return projections.drop_matching(base.table(spark, sf, "customer"), "^c_(acct|nation)", keep=("c_custkey",))


@query("drop_expanded_roots", """
    SELECT event_id, event_type AS "props.event.type", value AS "props.event.value",
           json_extract_string(props, '$.k') AS "props.k"
    FROM events""")
def drop_expanded_roots(spark, sf):
    expanded = base.table(spark, sf, "events").select(
        "event_id", "props",
        F.get_json_object("props", "$.k").alias("props.k"),
        F.to_json(F.struct("event_type", "value")).alias("props.event"),
        F.col("event_type").alias("props.event.type"),
        F.col("value").alias("props.event.value"),
    )
    return projections.drop_expanded_roots(expanded)


@query("fill_missing", """
    SELECT d.doc_id, coalesce(CAST(quality AS VARCHAR), '') AS quality, toxic
    FROM documents AS d LEFT JOIN labels AS l ON d.doc_id = l.doc_id""")
def fill_missing(spark, sf):
    labels = base.table(spark, sf, "labels").withColumn("quality", base.text("quality"))
    return projections.fill_missing(
        base.table(spark, sf, "documents").select("doc_id").join(labels, "doc_id", "left")
    )


@query("split_to_columns", """
    SELECT p_partkey, p_partkey || '.jpg' AS photo_file, p_size AS width, p_size * 2 AS height, CAST(NULL AS VARCHAR) AS mode
    FROM part""")
def split_to_columns(spark, sf):
    packed = base.table(spark, sf, "part").select(
        "p_partkey",
        F.concat_ws(",", F.concat(base.text("p_partkey"), F.lit(".jpg")), base.text("p_size"),
                    (F.col("p_size") * 2).cast("string")).alias("attributes"),
    )
    return projections.split_to_columns(
        packed, "attributes", ["photo_file", "width", "height", "mode"], {"width": "int", "height": "int"}
    ).drop("attributes")
