"""Row selection: predicates, patterns, id lists, category trees, first matches."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from listing_analytics.functions import text
from listing_analytics.operators.selection import FirstRows
from listing_analytics.sources.tables import quoted

# Table ids accepted for a pattern rule, and their other spellings.
TABLE_IDS = ("biz", "biz_photo", "review", "tip", "checkin", "pin", "photo_set")
TABLE_ALIASES = {"tips": "tip"}

Predicate = Callable[[Column], Column]


def join_on(df: DataFrame, other: DataFrame, keys: str | list[str], how: str) -> DataFrame:
    """Equi-join with the columns of `df` first, in their order; a plain join moves the keys to the front."""
    joined = df.join(other, keys, how)
    rest = [c for c in joined.columns if c not in df.columns]
    return joined.select(*[quoted(c) for c in df.columns + rest])


def require_columns(df: DataFrame, *names: str) -> None:
    """Refuse a plan that names columns the table does not have."""
    absent = [name for name in names if name not in df.columns]
    if absent:
        raise ValueError(f"columns {absent} not in table; it has {df.columns}")


def filter_where(df: DataFrame, column: str, predicate: Predicate) -> DataFrame:
    """Rows for which `predicate(column)` is true."""
    require_columns(df, column)
    return df.where(predicate(F.col(quoted(column))))


def filter_regex(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """Rows in which `pattern` is found anywhere in `column`; missing text never matches."""
    require_columns(df, column)
    return df.where(F.col(quoted(column)).rlike(pattern))


def filter_categories(
    df: DataFrame, categories: Iterable[str] | DataFrame, column: str = "categories", key: str = "business_id"
) -> DataFrame:
    """Rows whose delimited `column` holds at least one of `categories`.

    A list becomes a predicate. A one-column table is joined to the exploded values, and the
    matching keys select the rows, so neither side has to fit into memory.
    """
    require_columns(df, column)
    if not isinstance(categories, DataFrame):
        return df.where(text.any_value_in(F.col(quoted(column)), categories))
    require_columns(df, key)
    wanted = categories.select(F.col(quoted(categories.columns[0])).alias("_value"))
    matches = (
        df.select(F.col(quoted(key)), F.explode(text.split_values(F.col(quoted(column)))).alias("_value"))
        .join(wanted, "_value", "left_semi")
        .select(quoted(key))
    )
    return join_on(df, matches.distinct(), key, "left_semi")


def distinct_ids(ids: DataFrame, column: str) -> DataFrame:
    """The distinct ids of a table, taken from its column of that name, else its first.

    They are grouped by a second column as well, so that a join shuffles them once more. Adaptive
    execution splits a hot key only when both inputs of the join come straight from a shuffle;
    `distinct` alone would leave its aggregation in between.
    """
    name = column if column in ids.columns else ids.columns[0]
    key = ids.select(F.col(quoted(name)).alias(column))
    spread = F.pmod(F.xxhash64(quoted(column)), F.lit(2)).alias("_spread")
    return key.groupBy(quoted(column), spread).agg(F.lit(1)).select(quoted(column))


def _id_table(df: DataFrame, ids: Iterable | DataFrame, column: str, unique: bool) -> DataFrame:
    if isinstance(ids, DataFrame):
        if not unique:
            return distinct_ids(ids, column)
        return ids.select(F.col(quoted(column if column in ids.columns else ids.columns[0])).alias(column))
    # as text first: a list may spell ids otherwise than the column does
    values = [(None if value is None else str(value),) for value in dict.fromkeys(ids)]
    listed = df.sparkSession.createDataFrame(values, f"{quoted(column)} string")
    return listed.select(F.col(quoted(column)).cast(df.schema[column].dataType).alias(column))


def keep_ids(
    df: DataFrame, ids: Iterable | DataFrame, column: str = "business_id", unique: bool = False
) -> DataFrame:
    """Rows whose id is in `ids`: a list, or a table with a column of that name (else its first).

    A table's ids are made distinct before they move, which `unique` saves where they hardly
    repeat. Rows of a hot id are split by adaptive execution.
    """
    require_columns(df, column)
    ids = ids if isinstance(ids, DataFrame) else list(ids)
    return join_on(df, _id_table(df, ids, column, unique), column, "left_semi")


def drop_ids(
    df: DataFrame, ids: Iterable | DataFrame, column: str = "business_id", unique: bool = False
) -> DataFrame:
    """Rows whose id is not in `ids`; rows without an id are kept."""
    if ids is None:
        raise ValueError("excluding by id needs an id list")
    require_columns(df, column)
    ids = ids if isinstance(ids, DataFrame) else list(ids)
    return join_on(df, _id_table(df, ids, column, unique), column, "left_anti")


def first_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first `n` rows in the order of the unique columns `order`; the rows come in no order.

    The n-th key is found by counting, so rows are filtered and neither sorted nor shuffled. Where keys repeat, any rows of the last
    one fill up to `n`.
    """
    if n < 0:
        raise ValueError(f"row limit must not be negative: {n}")
    require_columns(df, *order)
    return FirstRows(df, n, *order).find().rows()


@dataclass(frozen=True)
class RegexRule:
    """Keep the rows of `table` in whose `column` the pattern is found."""

    table: str
    column: str
    pattern: str

    def __post_init__(self):
        if TABLE_ALIASES.get(self.table, self.table) not in TABLE_IDS:
            raise ValueError(f"unknown table id {self.table!r}; expected one of {TABLE_IDS}")


def rule_for(rules: Sequence[RegexRule], table: str) -> RegexRule | None:
    """The rule for a table; of several the last one counts."""
    wanted = TABLE_ALIASES.get(table, table)
    found = [r for r in rules if TABLE_ALIASES.get(r.table, r.table) == wanted]
    return found[-1] if found else None


@dataclass(frozen=True)
class RowFilter:
    """A conjunction of row conditions and an optional limit on the matching rows."""

    predicate_column: str | None = None
    predicate: Predicate | None = None
    rule: RegexRule | None = None
    id_column: str = "business_id"
    exclude_ids: bool = False
    unique_ids: bool = False
    limit: int | None = None
    order: tuple[str, ...] = ()

    def __post_init__(self):
        if (self.predicate is None) != (self.predicate_column is None):
            raise ValueError("a predicate and its column go together")
        if self.limit is not None and not self.order:
            raise ValueError("a row limit needs the unique columns that order the rows")


def apply_filter(df: DataFrame, spec: RowFilter, ids: Iterable | DataFrame | None = None) -> DataFrame:
    """The rows of `df` that satisfy every condition of `spec` and whose id is in `ids`."""
    if spec.exclude_ids and ids is None:
        raise ValueError("excluding by id needs an id list")
    if spec.predicate is not None:
        df = filter_where(df, spec.predicate_column, spec.predicate)
    if spec.rule is not None:
        df = filter_regex(df, spec.rule.column, spec.rule.pattern)
    if ids is not None:
        df = (drop_ids if spec.exclude_ids else keep_ids)(df, ids, spec.id_column, spec.unique_ids)
    return df if spec.limit is None else first_rows(df, spec.limit, *spec.order)


def category_children(
    tree: DataFrame, parent: str, exclude: str | Iterable[str] = (), trim: bool = False
) -> DataFrame:
    """Nodes that are `parent` or name it as a parent; one level only.

    `exclude` lists aliases to leave out, as a list or as comma-separated text, which is not
    stripped unless `trim` is set.
    """
    aliases = exclude.split(",") if isinstance(exclude, str) else list(exclude)
    aliases = [a.strip() if trim else a for a in aliases if a]
    nodes = tree.where(
        (F.col("alias") == parent) | F.coalesce(F.array_contains("parent_aliases", parent), F.lit(False))
    )
    return nodes.where(~F.col("alias").isin(aliases)) if aliases else nodes


def category_titles(tree: DataFrame, parent: str, exclude: str | Iterable[str] = (), trim: bool = False) -> DataFrame:
    """The titles of `category_children`."""
    return category_children(tree, parent, exclude, trim).select("title")
