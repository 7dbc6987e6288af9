"""Profiles."""

from pyspark.sql import functions as F

from listing_analytics.functions import text
from listing_analytics.operators import profile, projections
from listing_analytics.registry import base
from listing_analytics.registry.base import BUSINESS, CATEGORY, query
from listing_analytics.registry.labelling import ORDINAL_LIST
from listing_analytics.sinks.tables import text_safe


@query("column_range", """
    SELECT min(l_quantity) AS min_l_quantity, max(l_quantity) AS max_l_quantity,
           min(l_extendedprice) AS min_l_extendedprice, max(l_extendedprice) AS max_l_extendedprice
    FROM lineitem""")
def column_range(spark, sf):
    return profile.column_range(base.table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice")


@query("value_counts", "SELECT l_quantity, count(*) AS count FROM lineitem GROUP BY l_quantity")
def value_counts(spark, sf):
    return profile.value_counts(base.table(spark, sf, "lineitem"), "l_quantity")


@query("distinct_profile", """
    SELECT 'l_returnflag' AS "column", l_returnflag AS value, count(*) AS count FROM lineitem GROUP BY l_returnflag
    UNION ALL
    SELECT 'l_linestatus', l_linestatus, count(*) FROM lineitem GROUP BY l_linestatus
    UNION ALL
    SELECT 'l_linenumber', CAST(l_linenumber AS VARCHAR), count(*) FROM lineitem GROUP BY l_linenumber""")
def distinct_profile(spark, sf):
    return profile.distinct_values(
        base.table(spark, sf, "lineitem"), "l_returnflag", "l_linestatus", "l_linenumber"
    )


@query("distinct_arrays", f"""
    WITH b AS ({BUSINESS}), span AS (SELECT min(stars) AS low, max(stars) AS high FROM b)
    SELECT DISTINCT CAST(to_json({ORDINAL_LIST}) AS VARCHAR) AS stars_ord FROM b, span""")
def distinct_arrays(spark, sf):
    return text_safe(profile.distinct_of(projections.add_labels(base.business(spark, sf)), "stars_ord"))


@query("distinct_ids", "SELECT DISTINCT o_custkey FROM orders")
def distinct_ids(spark, sf):
    return profile.distinct_of(base.table(spark, sf, "orders"), "o_custkey")


@query("row_counts", f"""
    SELECT count(*) AS loaded,
           count(*) FILTER (list_contains(list_transform(string_split(categories, ','), lambda x: trim(x)), '{CATEGORY}'))
               AS identified,
           count(*) FILTER (stars < 2) AS dropped
    FROM ({BUSINESS}) AS b""")
def row_counts(spark, sf):
    return profile.row_counts(
        base.business(spark, sf),
        identified=text.any_value_in(F.col("categories"), [CATEGORY]),
        dropped=F.col("stars") < 2,
    )


@query("frequency_table", """
    SELECT l_quantity, count(*) AS count, count(*)::DOUBLE / sum(count(*)) OVER ()::DOUBLE AS percent
    FROM lineitem GROUP BY l_quantity""")
def frequency_table(spark, sf):
    return profile.frequency_table(base.table(spark, sf, "lineitem"), "l_quantity")
