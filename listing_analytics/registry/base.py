"""Registration of queries with their SQL, and the roles the given tables play in them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without `sql` its result is not compared with SQL."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A given table; its footers are read for the schema once per process, not once per query."""
    path = f"{sf.rstrip('/')}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """The same rows dealt evenly to `spark.sql.shuffle.partitions` tasks, for small columns from which much work follows.

    A scan gives a row group to one task, however many rows it has.
    """
    return df.repartition(max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1))


def text(name: str):
    return F.col(name).cast("string")


# Every role below is a view of one whole table, given as a DataFrame and as SQL.

def business(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        text("p_partkey").alias("business_id"),
        F.replace("p_name", F.lit(" "), F.lit(", ")).alias("categories"),
        (F.lit(1.0) + F.col("p_size") % 9 / F.lit(2.0)).alias("stars"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("kind"),
    )


BUSINESS = """
    SELECT CAST(p_partkey AS VARCHAR) AS business_id, replace(p_name, ' ', ', ') AS categories,
           1.0::DOUBLE + (p_size % 9) / 2.0::DOUBLE AS stars, p_brand AS brand, p_type AS kind
    FROM part"""


def photos(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        text("o_orderkey").alias("photo_id"), text("o_custkey").alias("business_id"),
        F.col("o_orderstatus").alias("label"),
    )


PHOTOS = """
    SELECT CAST(o_orderkey AS VARCHAR) AS photo_id, CAST(o_custkey AS VARCHAR) AS business_id,
           o_orderstatus AS label
    FROM orders"""


def reviews(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        text("l_partkey").alias("business_id"),
        F.col("l_quantity").cast("int").cast("string").alias("stars"),
        text("l_linenumber").alias("cool"),
        F.col("l_returnflag").alias("flag"),
        F.col("l_extendedprice").alias("price"),
    )


REVIEWS = """
    SELECT CAST(l_partkey AS VARCHAR) AS business_id, CAST(CAST(l_quantity AS INT) AS VARCHAR) AS stars,
           CAST(l_linenumber AS VARCHAR) AS cool, l_returnflag AS flag, l_extendedprice AS price
    FROM lineitem"""


def tips(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        text("event_id").alias("tip_id"), text("user_id").alias("business_id"),
        F.col("event_type").alias("kind"), F.col("value").alias("compliment_count"),
    )


TIPS = """
    SELECT CAST(event_id AS VARCHAR) AS tip_id, CAST(user_id AS VARCHAR) AS business_id,
           event_type AS kind, value AS compliment_count
    FROM events"""


def checkins(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        text("event_id").alias("checkin_id"), text("user_id").alias("business_id"), F.col("ts").alias("date"),
    )


CHECKINS = """
    SELECT CAST(event_id AS VARCHAR) AS checkin_id, CAST(user_id AS VARCHAR) AS business_id, ts AS date
    FROM events"""


def tree(spark: SparkSession, sf: str) -> DataFrame:
    """Regions without a parent, nations below them, customers below a nation and a segment."""
    region, nation, customer = (table(spark, sf, t) for t in ("region", "nation", "customer"))
    none = F.lit(None).cast("array<string>")
    return (
        region.select(F.col("r_name").alias("alias"), F.lower("r_name").alias("title"), none.alias("parent_aliases"))
        .unionByName(
            nation.join(region, nation.n_regionkey == region.r_regionkey).select(
                F.col("n_name").alias("alias"), F.lower("n_name").alias("title"),
                F.array("r_name").alias("parent_aliases"),
            )
        )
        .unionByName(
            customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
                F.col("c_name").alias("alias"), F.lower("c_name").alias("title"),
                F.array("n_name", "c_mktsegment").alias("parent_aliases"),
            )
        )
    )


TREE = """
    SELECT r_name AS alias, lower(r_name) AS title, CAST(NULL AS VARCHAR[]) AS parent_aliases FROM region
    UNION ALL
    SELECT n_name, lower(n_name), [r_name] FROM nation JOIN region ON n_regionkey = r_regionkey
    UNION ALL
    SELECT c_name, lower(c_name), [n_name, c_mktsegment]
    FROM customer JOIN nation ON c_nationkey = n_nationkey"""


# Businesses of one category; the ids the record queries select by.
CATEGORY = "ring"

RING_IDS = f"""
    SELECT business_id FROM ({BUSINESS}) AS b
    WHERE list_contains(list_transform(string_split(categories, ','), lambda x: trim(x)), '{CATEGORY}')"""


def ring_ids(spark: SparkSession, sf: str) -> DataFrame:
    from listing_analytics.operators.filters import filter_categories

    return filter_categories(business(spark, sf), [CATEGORY]).select("business_id")


def pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Half stars of truth and prediction, one pair per line item; the highest class is never predicted."""
    shift = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(3)
    quantity = F.col("l_quantity").cast("int")
    return table(spark, sf, "lineitem").select(
        (quantity % 9 + 2).alias("actual"), ((quantity + shift) % 8 + 2).alias("predicted")
    )


PAIRS = """
    SELECT CAST(l_quantity AS INT) % 9 + 2 AS actual,
           (CAST(l_quantity AS INT) + CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 3 END) % 8 + 2
               AS predicted
    FROM lineitem"""


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("embedding"), "label"
    )


def by_position(df: DataFrame, key: str, column: str, digits: int = 6) -> DataFrame:
    """A list column as rows `key, position, value`, so that values compare with a fixed precision."""
    return df.select(key, F.posexplode(column).alias("position", "v")).select(
        key, "position", (F.round("v", digits) + F.lit(0.0)).alias("value")
    )
