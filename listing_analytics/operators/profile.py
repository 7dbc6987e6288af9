"""Profiles: ranges, counts, distinct values, frequency tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

from listing_analytics.operators.filters import require_columns
from listing_analytics.sources.tables import quoted


def column_range(df: DataFrame, *columns: str) -> DataFrame:
    """One row with `min_<column>` and `max_<column>` of each column."""
    require_columns(df, *columns)
    return df.agg(*[
        f(quoted(c)).alias(f"{name}_{c}") for c in columns for name, f in (("min", F.min), ("max", F.max))
    ])


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first; missing values are not counted."""
    require_columns(df, column)
    return (
        df.where(F.col(quoted(column)).isNotNull())
        .groupBy(quoted(column)).agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), quoted(column))
    )


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    """`column, value, count` of every value of several columns in one pass, values as text."""
    require_columns(df, *columns)
    cells = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(quoted(c)).cast("string").alias("value")) for c in columns
    ])
    return df.select(F.explode(cells).alias("cell")).groupBy("cell.column", "cell.value").agg(
        F.count(F.lit(1)).alias("count")
    )


def distinct_of(df: DataFrame, *columns: str) -> DataFrame:
    """Distinct combinations of columns; list columns compare as whole lists."""
    require_columns(df, *columns)
    return df.select(*[quoted(c) for c in columns]).distinct()


def frequency_table(df: DataFrame, column: str, by: str | None = None, weight: str | None = None) -> DataFrame:
    """Rows per value of `column` and their share of all, or of the rows of the same `by` group.

    Missing values are not counted. The totals come from the counts, not from the table. `weight` names a column with
    the number of rows that a row stands for.
    """
    keys = [c for c in (by, column) if c]
    require_columns(df, *keys)
    counts = df.where(F.col(quoted(column)).isNotNull()).groupBy(*[quoted(k) for k in keys]).agg(
        (F.count(F.lit(1)) if weight is None else F.sum(quoted(weight))).alias("count")
    )
    if by is None:
        total: Column = counts.agg(F.sum("count")).scalar()
        return counts.withColumn("percent", F.col("count") / total)
    totals = counts.groupBy(quoted(by)).agg(F.sum("count").alias("_total"))
    return counts.join(totals, by).withColumn("percent", F.col("count") / F.col("_total")).drop("_total")


def observed(df: DataFrame, name: str, **conditions: Column) -> tuple[DataFrame, Observation]:
    """`df` that counts its rows, and those satisfying each condition, while another action reads it."""
    counts = Observation(name)
    return df.observe(
        counts, F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(k) for k, c in conditions.items()]
    ), counts


def row_counts(df: DataFrame, **conditions: Column) -> DataFrame:
    """One row: all rows as `loaded` and those satisfying each condition."""
    return df.agg(F.count(F.lit(1)).alias("loaded"), *[F.count_if(c).alias(k) for k, c in conditions.items()])


def class_sets(df: DataFrame, column: str, split: str = "split", left: str = "train",
               right: str = "validation") -> DataFrame:
    """Every class of two splits and which of them has it."""
    has = [F.max((F.col(quoted(split)) == s).cast("int")) for s in (left, right)]
    return (
        df.where(F.col(quoted(split)).isin(left, right))
        .groupBy(quoted(column))
        .agg(has[0].alias(f"in_{left}"), has[1].alias(f"in_{right}"))
        .withColumn("matches", (F.col(f"in_{left}") == F.col(f"in_{right}")).cast("int"))
    )


def require_same_classes(df: DataFrame, column: str, **options) -> None:
    """Raise when two splits do not hold the same classes."""
    odd = class_sets(df, column, **options).where("matches = 0")
    total = odd.count()
    if total:
        first = [row[0] for row in odd.orderBy(quoted(column)).limit(20).collect()]
        raise ValueError(f"{total} classes found in one split only, the first of them {first}")
