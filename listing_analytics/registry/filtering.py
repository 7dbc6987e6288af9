"""Filters."""

from pyspark.sql import functions as F

from listing_analytics.operators import filters
from listing_analytics.plans.subset import SubsetSpec, records_for_ids, staged_prefilter
from listing_analytics.registry import base
from listing_analytics.registry.base import BUSINESS, PHOTOS, REVIEWS, RING_IDS, TIPS, TREE, CHECKINS, query

# More segments than regions, so that children come from every level of the tree.
PARENT = "NATION_7"


@query("category_children", f"""
    SELECT alias, title FROM ({TREE}) AS t
    WHERE alias = '{PARENT}' OR coalesce(list_contains(parent_aliases, '{PARENT}'), false)""")
def category_children(spark, sf):
    return filters.category_children(base.tree(spark, sf), PARENT).select("alias", "title")


@query("category_exclude", f"""
    SELECT title FROM ({TREE}) AS t
    WHERE (alias = 'BUILDING' OR coalesce(list_contains(parent_aliases, 'BUILDING'), false))
      AND alias NOT IN ('Customer#000000005', 'Customer#000000010', 'Customer#000000011')""")
def category_exclude(spark, sf):
    excluded = "Customer#000000005,Customer#000000010,Customer#000000011"
    return filters.category_titles(base.tree(spark, sf), "BUILDING", excluded)


@query("category_match", f"""
    SELECT business_id, categories, stars FROM ({BUSINESS}) AS b
    WHERE list_has_any(list_transform(string_split(categories, ','), lambda x: trim(x)), ['ring', 'red'])""")
def category_match(spark, sf):
    return filters.filter_categories(base.business(spark, sf), ["ring", "red"]).select(
        "business_id", "categories", "stars"
    )


@query("category_match_table", f"""
    SELECT business_id, categories FROM ({BUSINESS}) AS b
    WHERE list_has_any(list_transform(string_split(categories, ','), lambda x: trim(x)),
                       (SELECT list(DISTINCT split_part(p_name, ' ', 2)) FROM part WHERE p_type = 'PROMO'
                          AND p_name LIKE 'small%'))""")
def category_match_table(spark, sf):
    wanted = base.table(spark, sf, "part").where("p_type = 'PROMO' and p_name like 'small%'").select(
        F.get(F.split("p_name", " "), F.lit(1)).alias("category")
    )
    return filters.filter_categories(base.business(spark, sf), wanted).select("business_id", "categories")


@query("predicate_hook", f"SELECT business_id, stars FROM ({BUSINESS}) AS b WHERE stars >= 4.0")
def predicate_hook(spark, sf):
    return filters.filter_where(base.business(spark, sf), "stars", lambda c: c >= 4.0).select("business_id", "stars")


@query("regex_filter", f"""
    SELECT business_id, brand FROM ({BUSINESS}) AS b WHERE regexp_matches(brand, '#1[0-5]?$')""")
def regex_filter(spark, sf):
    return filters.filter_regex(base.business(spark, sf), "brand", "#1[0-5]?$").select("business_id", "brand")


@query("regex_routing", f"""
    SELECT 'biz' AS tab, business_id AS id FROM ({BUSINESS}) AS b WHERE regexp_matches(kind, '^(SMALL|LARGE)$')
    UNION ALL
    SELECT 'pin', photo_id FROM ({PHOTOS}) AS p WHERE regexp_matches(label, 'F|P')
    UNION ALL
    SELECT 'tip', tip_id FROM ({TIPS}) AS t WHERE regexp_matches(kind, '^v')""")
def regex_routing(spark, sf):
    rules = (
        filters.RegexRule("biz", "brand", "#9$"),
        filters.RegexRule("pin", "label", "F|P"),
        filters.RegexRule("tips", "kind", "^v"),
        filters.RegexRule("biz", "kind", "^(SMALL|LARGE)$"),
    )
    tables = {
        "biz": (base.business(spark, sf), "business_id"),
        "pin": (base.photos(spark, sf), "photo_id"),
        "tip": (base.tips(spark, sf), "tip_id"),
    }
    parts = [
        filters.apply_filter(df, filters.RowFilter(rule=filters.rule_for(rules, name))).select(
            F.lit(name).alias("tab"), F.col(key).alias("id")
        )
        for name, (df, key) in tables.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("id_semi_filter", """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'HOUSEHOLD')""")
def id_semi_filter(spark, sf):
    ids = base.table(spark, sf, "customer").where("c_mktsegment = 'HOUSEHOLD'").select("c_custkey")
    return filters.keep_ids(base.table(spark, sf, "orders"), ids, "o_custkey").select(
        "o_orderkey", "o_custkey", "o_totalprice"
    )


@query("id_anti_filter", """
    SELECT c_custkey, c_name FROM customer
    WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')""")
def id_anti_filter(spark, sf):
    ids = base.table(spark, sf, "orders").where("o_orderstatus = 'F'").select("o_custkey")
    return filters.drop_ids(base.table(spark, sf, "customer"), ids, "c_custkey").select("c_custkey", "c_name")


@query("filter_chain", f"""
    SELECT business_id, stars, flag, price FROM ({REVIEWS}) AS r
    WHERE price > 20000 AND regexp_matches(flag, '^[AR]$') AND business_id IN ({RING_IDS})""")
def filter_chain(spark, sf):
    spec = filters.RowFilter(
        predicate_column="price", predicate=lambda c: c > 20000,
        rule=filters.RegexRule("review", "flag", "^[AR]$"),
    )
    return filters.apply_filter(base.reviews(spark, sf), spec, base.ring_ids(spark, sf)).select(
        "business_id", "stars", "flag", "price"
    )


@query("limit_matches", """
    SELECT o_orderkey, o_orderstatus FROM orders WHERE regexp_matches(o_orderstatus, 'F')
    ORDER BY o_orderkey LIMIT 500""")
def limit_matches(spark, sf):
    spec = filters.RowFilter(
        rule=filters.RegexRule("pin", "o_orderstatus", "F"), limit=500, order=("o_orderkey",)
    )
    return filters.apply_filter(base.table(spark, sf, "orders"), spec).select("o_orderkey", "o_orderstatus")


@query("head_scan", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 1000")
def head_scan(spark, sf):
    return filters.first_rows(base.table(spark, sf, "orders").select("o_orderkey", "o_custkey"), 1000, "o_orderkey")


@query("reviews_for_ids", f"""
    SELECT business_id, stars, cool FROM ({REVIEWS}) AS r WHERE business_id IN ({RING_IDS})""")
def reviews_for_ids(spark, sf):
    return records_for_ids(base.reviews(spark, sf), base.ring_ids(spark, sf), SubsetSpec(), "review").select(
        "business_id", "stars", "cool"
    )


@query("tips_for_ids", f"SELECT * FROM ({TIPS}) AS t WHERE business_id IN ({RING_IDS})")
def tips_for_ids(spark, sf):
    return records_for_ids(base.tips(spark, sf), base.ring_ids(spark, sf), SubsetSpec(), "tip")


@query("checkins_for_ids", f"SELECT * FROM ({CHECKINS}) AS c WHERE business_id IN ({RING_IDS})")
def checkins_for_ids(spark, sf):
    return records_for_ids(base.checkins(spark, sf), base.ring_ids(spark, sf), SubsetSpec(), "checkin")


@query("photos_for_ids", f"""
    SELECT * FROM ({PHOTOS}) AS p WHERE business_id IN ({RING_IDS}) AND regexp_matches(label, '^[FO]$')""")
def photos_for_ids(spark, sf):
    spec = SubsetSpec(rules=(filters.RegexRule("pin", "label", "^[FO]$"),))
    return records_for_ids(base.photos(spark, sf), base.ring_ids(spark, sf), spec, "photo")


@query("staged_prefilter", f"""
    SELECT business_id, stars, flag FROM ({REVIEWS}) AS r
    WHERE business_id IN ({RING_IDS}) AND regexp_matches(flag, 'N')""")
def prefilter(spark, sf):
    spec = SubsetSpec(rules=(filters.RegexRule("review", "flag", "N"),))
    reviews = base.reviews(spark, sf).select("business_id", "stars", "flag")
    return staged_prefilter(reviews, base.ring_ids(spark, sf), spec)
