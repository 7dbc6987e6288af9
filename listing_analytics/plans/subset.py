"""Extraction of a subset: categories, businesses, and the records of those businesses."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from listing_analytics.operators import filters, projections
from listing_analytics.sinks import tables as sinks
from listing_analytics.staging import stage

ENTITIES = ("review", "tip", "checkin", "photo")

# Table id under which a pattern rule reaches an entity.
RULE_IDS = {"business": "biz", "review": "review", "tip": "tip", "checkin": "checkin", "photo": "pin"}


@dataclass(frozen=True)
class SubsetSpec:
    """What to extract.

    `parent` and `exclude` choose the categories; `rules` are patterns per table; `drop` is a
    pattern of column names; `limit` caps the matching rows of every table, in the order of the
    columns `order` names for it.
    """

    parent: str | None = None
    exclude: str | Sequence[str] = ()
    rules: tuple[filters.RegexRule, ...] = ()
    drop: str | None = None
    limit: int | None = None
    order: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    key: str = "business_id"

    def rows(self, entity: str, rule_id: str | None = None, unique_ids: bool = False) -> filters.RowFilter:
        return filters.RowFilter(
            unique_ids=unique_ids,
            rule=filters.rule_for(self.rules, rule_id or RULE_IDS[entity]),
            id_column=self.key,
            limit=self.limit,
            order=self.order.get(entity, ()),
        )


def business_extract(
    business: DataFrame,
    spec: SubsetSpec,
    categories: Iterable[str] | DataFrame | None = None,
    ids: Iterable | DataFrame | None = None,
    rule_id: str = "biz",
) -> DataFrame:
    """The businesses of these categories and ids, without expanded root columns and missing text."""
    if categories is not None:
        business = filters.filter_categories(business, categories, key=spec.key)
    rows = filters.apply_filter(business, spec.rows("business", rule_id), ids)
    if spec.drop:
        rows = projections.drop_matching(rows, spec.drop, keep=(spec.key,))
    return projections.fill_missing(projections.drop_expanded_roots(rows))


def records_for_ids(
    records: DataFrame, ids: Iterable | DataFrame | None, spec: SubsetSpec, entity: str, unique_ids: bool = False
) -> DataFrame:
    """The reviews, tips, check-ins or photos of these businesses; of all without `ids`."""
    rows = filters.apply_filter(records, spec.rows(entity, unique_ids=unique_ids), ids)
    return projections.drop_matching(rows, spec.drop, keep=(spec.key,)) if spec.drop else rows


def staged_prefilter(
    records: DataFrame, ids: Iterable | DataFrame, spec: SubsetSpec, entity: str = "review"
) -> DataFrame:
    """Records selected by id first and written, then filtered further from the written table."""
    kept = stage(filters.keep_ids(records, ids, spec.key), f"prefilter-{entity}")
    return records_for_ids(kept, None, spec, entity)


@dataclass(frozen=True)
class Subset:
    business: DataFrame
    ids: DataFrame
    records: dict[str, DataFrame]


def run_subset(
    spec: SubsetSpec,
    business: DataFrame | None = None,
    tree: DataFrame | None = None,
    categories: Iterable[str] | DataFrame | None = None,
    ids: Iterable | DataFrame | None = None,
    **records: DataFrame,
) -> Subset:
    """Categories, businesses and their records in one go.

    Categories come from `categories` or from the children of `spec.parent` in `tree`; `ids` skips
    that search. The id table is written once and feeds every semi-join.
    """
    unknown = set(records) - set(ENTITIES)
    if unknown:
        raise ValueError(f"unknown entities {sorted(unknown)}; expected {ENTITIES}")
    if categories is None and tree is not None:
        categories = filters.category_titles(tree, spec.parent, spec.exclude)
    if ids is None and (business is None or categories is None):
        raise ValueError("businesses need an id list, or a business table and categories")
    found = None if business is None else business_extract(business, spec, categories, ids)
    if ids is None:
        id_table = stage(found.select(spec.key), "ids")
    elif isinstance(ids, DataFrame):
        id_table = ids
    else:
        spark: SparkSession = (business if business is not None else next(iter(records.values()))).sparkSession
        id_table = spark.createDataFrame([(i,) for i in ids], f"`{spec.key}` string")
    # the ids of found businesses are one per business
    unique = ids is None
    return Subset(
        found, id_table, {e: records_for_ids(df, id_table, spec, e, unique) for e, df in records.items()}
    )


def write_subset(subset: Subset, folder: str, columnar: bool = False) -> dict[str, int]:
    """Write every table of a subset, and the id list; returns the rows written per table."""
    write = sinks.write_parquet if columnar else sinks.write_csv
    tables = dict(subset.records)
    if subset.business is not None:
        tables["business"] = subset.business
    sinks.write_lines(subset.ids, f"{folder}/business_ids", subset.ids.columns[0])
    return {name: write(df, f"{folder}/{name}") for name, df in tables.items()}
