"""Labels and targets."""

from pyspark.sql import functions as F

from listing_analytics.operators import projections
from listing_analytics.registry import base
from listing_analytics.registry.base import BUSINESS, query
from listing_analytics.sinks.tables import text_safe


@query("label_categorical", f"""
    SELECT business_id, replace(CAST(stars AS VARCHAR), '.', '_') AS stars_cat FROM ({BUSINESS}) AS b""")
def label_categorical(spark, sf):
    return projections.add_labels(base.business(spark, sf)).select("business_id", "stars_cat")


@query("label_numeric", f"""
    SELECT business_id, stars, CAST(ceil(stars * 2) AS INT) AS stars_num FROM ({BUSINESS}) AS b""")
def label_numeric(spark, sf):
    return projections.add_labels(base.business(spark, sf)).select("business_id", "stars", "stars_num")


ORDINAL_LIST = """list_transform(range(CAST(ceil((high - low) * 2) AS BIGINT) + 1),
                                 lambda i: CASE WHEN i < ceil((stars - low) * 2) THEN 1 ELSE 0 END)"""


@query("label_ordinal", f"""
    WITH b AS ({BUSINESS}), span AS (SELECT min(stars) AS low, max(stars) AS high FROM b)
    SELECT business_id, CAST(to_json({ORDINAL_LIST}) AS VARCHAR) AS stars_ord FROM b, span""")
def label_ordinal(spark, sf):
    return text_safe(projections.add_labels(base.business(spark, sf)).select("business_id", "stars_ord"))


@query("expand_list_columns", f"""
    WITH b AS ({BUSINESS}), span AS (SELECT min(stars) AS low, max(stars) AS high FROM b),
         o AS (SELECT business_id, {ORDINAL_LIST} AS l FROM b, span)
    SELECT business_id, {', '.join(f'l[{i + 1}] AS t{i}' for i in range(9))} FROM o""")
def expand_list_columns(spark, sf):
    labelled = projections.add_labels(base.business(spark, sf)).select("business_id", "stars_ord")
    return projections.expand_list(labelled, "stars_ord", length=9).drop("stars_ord")


CLASSES = "SELECT list(DISTINCT kind ORDER BY kind) AS classes FROM ({0}) AS c"


@query("target_onehot", f"""
    WITH b AS ({BUSINESS}), k AS ({CLASSES.format(BUSINESS)})
    SELECT business_id, CAST(to_json(list_transform(classes, lambda c: CAST(c = kind AS INT))) AS VARCHAR) AS target
    FROM b, k""")
def target_onehot(spark, sf):
    encoded = projections.encode_target(base.business(spark, sf), "kind", "categorical")
    return text_safe(encoded.select("business_id", "target"))


@query("target_sparse", f"""
    WITH b AS ({BUSINESS}), k AS ({CLASSES.format(BUSINESS)})
    SELECT business_id, kind, CAST(list_position(classes, kind) - 1 AS INT) AS target FROM b, k""")
def target_sparse(spark, sf):
    return projections.encode_target(base.business(spark, sf), "kind", "sparse").select(
        "business_id", "kind", "target"
    )


@query("target_binary", """
    SELECT doc_id, CASE WHEN toxic = 1 THEN 1 ELSE 0 END AS target FROM labels""")
def target_binary(spark, sf):
    named = base.table(spark, sf, "labels").withColumn("class", F.when(F.col("toxic") == 1, "toxic").otherwise("fine"))
    return projections.encode_target(named, "class", "binary").select("doc_id", "target")
