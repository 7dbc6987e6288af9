"""JSON inputs: category tree, class map, nested records."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from listing_analytics import schemas
from listing_analytics.functions import labels


def categories_from_json(df: DataFrame, column: str = "value") -> DataFrame:
    """Category nodes, one per row, from JSON texts that hold a `categories` array."""
    parsed = F.from_json(F.col(column), schemas.CATEGORY_DOCUMENT)
    return df.select(F.explode(parsed["categories"]).alias("node")).select("node.*")


def read_categories(spark: SparkSession, path: str) -> DataFrame:
    """Category nodes from JSON files that hold a `categories` array."""
    return (
        spark.read.schema(schemas.CATEGORY_DOCUMENT)
        .json(path, multiLine=True)
        .select(F.explode("categories").alias("node"))
        .select("node.*")
    )


def class_map_entries(df: DataFrame, column: str = "value") -> DataFrame:
    """Class maps as rows `class_idx, cat, stars` from JSON objects `{"0": "1_0", ...}`."""
    entries = F.from_json(F.col(column), T.MapType(T.StringType(), T.StringType()))
    return df.select(F.explode(entries).alias("key", "cat")).select(
        F.col("key").cast("int").alias("class_idx"), "cat", labels.category_stars(F.col("cat")).alias("stars")
    )


def read_class_map(spark: SparkSession, path: str) -> DataFrame:
    """`class_idx, cat, stars` from a class-map file."""
    return class_map_entries(spark.read.text(path, wholetext=True))


def _leaves(schema: T.StructType, path: tuple[str, ...] = ()) -> Iterator[tuple[str, ...]]:
    for field in schema.fields:
        if isinstance(field.dataType, T.StructType):
            yield from _leaves(field.dataType, (*path, field.name))
        else:
            yield (*path, field.name)


def _field(path: tuple[str, ...]) -> Column:
    column = F.col("`" + path[0].replace("`", "``") + "`")
    for name in path[1:]:
        column = column.getField(name)
    return column


def flatten_struct(df: DataFrame, keep_roots: bool = False) -> DataFrame:
    """Nested structs as columns with dotted names; `keep_roots` also keeps each root as JSON text."""
    columns = []
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StructType):
            if keep_roots:
                columns.append(F.to_json(_field((field.name,))).alias(field.name))
            columns += [
                _field(path).alias(".".join(path)) for path in _leaves(T.StructType([field]))
            ]
        else:
            columns.append(_field((field.name,)))
    return df.select(columns)


def read_json_flat(spark: SparkSession, path: str, schema: T.StructType | str | None = None, **options) -> DataFrame:
    """JSON lines as a flat table with dotted names; without a schema the files are read twice."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return flatten_struct(reader.json(path), **options)
