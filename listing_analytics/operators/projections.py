"""Column selection and derivation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from listing_analytics.functions import labels
from listing_analytics.sources.tables import matching_columns, quoted


def drop_matching(df: DataFrame, pattern: str, keep: Sequence[str] = ()) -> DataFrame:
    """Drop the columns in whose name `pattern` is found; refuse to drop one of `keep`."""
    names = matching_columns(df, pattern)
    needed = [name for name in names if name in keep]
    if needed:
        raise ValueError(f"pattern {pattern!r} would drop needed columns {needed}")
    return df.drop(*names)


def drop_expanded_roots(df: DataFrame) -> DataFrame:
    """Drop every column that is a proper dotted prefix of another, as its values have their own columns."""
    roots = set()
    for name in df.columns:
        parts = name.split(".")
        roots.update(".".join(parts[:i]) for i in range(1, len(parts)))
    return df.drop(*roots)


def fill_missing(df: DataFrame, value: str = "") -> DataFrame:
    """Replace missing text by `value`; other types keep their nulls."""
    return df.select([
        (F.coalesce(F.col(quoted(f.name)), F.lit(value)) if isinstance(f.dataType, T.StringType)
         else F.col(quoted(f.name))).alias(f.name)
        for f in df.schema.fields
    ])


def add_labels(df: DataFrame, stars: str = "stars", scale: DataFrame | None = None) -> DataFrame:
    """Add `stars_cat`, `stars_ord` and `stars_num`.

    The list's range is the range of `stars` in `scale`, by default in `df` itself: one row,
    read as a scalar, so that the table is neither shuffled nor joined.
    """
    value = F.col(quoted(stars))
    span = (df if scale is None else scale).agg(F.struct(F.min(stars).alias("low"), F.max(stars).alias("high")))
    return (
        df.withColumn("_span", span.scalar())
        .withColumns({
            "stars_cat": labels.categorical(value),
            "stars_ord": labels.ordinal(value, F.col("_span")["low"], F.col("_span")["high"]),
            "stars_num": labels.numeric(value),
        })
        .drop("_span")
    )


def split_to_columns(
    df: DataFrame, column: str, names: Sequence[str], types: dict[str, str] | None = None, separator: str = ","
) -> DataFrame:
    """A delimited string as named columns, cast where `types` says so; missing parts are null."""
    parts = F.split(F.col(quoted(column)), separator)
    types = types or {}
    return df.withColumns({
        name: F.get(parts, F.lit(i)).cast(types.get(name, "string")) for i, name in enumerate(names)
    })


def expand_list(df: DataFrame, column: str, length: int | None = None, prefix: str = "t") -> DataFrame:
    """A list as the columns `t0, t1, ...`; without `length` the longest list is looked up first."""
    if length is None:
        length = df.agg(F.max(F.size(quoted(column)))).head()[0] or 0
    return df.withColumns({f"{prefix}{i}": F.get(quoted(column), F.lit(i)) for i in range(length)})


def class_list(df: DataFrame, column: str) -> DataFrame:
    """One row: the sorted classes of a label column."""
    return df.agg(F.array_sort(F.collect_set(quoted(column))).alias("classes"))


def encode_target(df: DataFrame, column: str, mode: str = "categorical", ordinal: str = "stars_ord") -> DataFrame:
    """Add a model target for `column`.

    `sparse` and `binary` add its class index as `target`, `categorical` a 0/1 list with one
    entry per class, `raw` the list columns of `ordinal`.
    """
    if mode == "raw":
        return expand_list(df, ordinal)
    if mode not in ("categorical", "sparse", "binary"):
        raise ValueError(f"class mode {mode!r} not known; expected categorical, sparse, binary or raw")
    with_classes = df.withColumn("_classes", class_list(df, column).scalar())
    encode = labels.one_hot if mode == "categorical" else labels.class_index
    return with_classes.withColumn("target", encode(F.col(quoted(column)), F.col("_classes"))).drop("_classes")


def class_map(df: DataFrame, column: str) -> DataFrame:
    """`class_idx, cat, stars` of the classes of a label column, indexed in sorted order."""
    return class_list(df, column).select(F.posexplode("classes").alias("class_idx", "cat")).withColumn(
        "stars", labels.category_stars(F.col("cat"))
    )
