"""Entity tables from CSV, and the typing of text columns."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from listing_analytics import schemas
from listing_analytics.functions import text
from listing_analytics.sources import csv_records

CORRUPT = "_corrupt_record"


def quoted(name: str) -> str:
    """A column name as an identifier, so that dots in it are not field accesses."""
    return "`" + name.replace("`", "``") + "`"


def with_file_order(df: DataFrame, name: str = "file_order") -> DataFrame:
    """Add a unique column that orders the rows as they stand in their files, files by path.

    `df` must come straight from a file scan. The order is a key for `first_rows` and
    `with_ordinal`, not a position; later scans of the session give rows the same keys.
    """
    csv_records.pin_splits(df.sparkSession)
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return df.withColumn(name, place)


def apply_types(
    df: DataFrame,
    types: Mapping[str, str],
    flags: Iterable[str] = (),
    missing: Iterable[str] = text.MISSING_TOKENS,
    strict_flags: bool = False,
) -> DataFrame:
    """Type a table of text columns: casts, nullable booleans, and null for missing cells.

    Columns named by `types` or `flags` but absent from `df` are ignored, and columns that are not
    text are kept as they are.
    """
    flag_names, tokens = set(flags), list(missing)
    columns = []
    for name, kind in df.dtypes:
        cell = F.col(quoted(name))
        if kind != "string":
            typed = cell
        elif name in flag_names:
            typed = text.nullable_bool(cell, strict_flags)
        elif tokens:
            typed = text.missing_to_null(cell, tokens)
        else:
            typed = cell
        if name in types:
            typed = typed.cast(types[name])
        columns.append(typed.alias(name))
    return df.select(columns)


def read_text_table(
    spark: SparkSession,
    path: str,
    multi_line: bool = True,
    max_field_chars: int = -1,
    mode: str = "FAILFAST",
    file_order: str | None = None,
) -> DataFrame:
    """A CSV file with a header, all columns as text under their header names.

    A large file is split over many tasks. `multi_line` allows line breaks inside quotes, at the price
    of a second pass over the lines; without it each line is a row. A row with fewer or more cells than the
    header is malformed and ends the read; `mode="PERMISSIVE"` keeps such rows and adds their raw
    text as `_corrupt_record`. `file_order` names a column that orders the rows as they stand in their
    files, files by path: a key for `first_rows` and `with_ordinal`, not a position.
    """
    if mode not in ("FAILFAST", "PERMISSIVE"):
        raise ValueError(f"mode must be 'FAILFAST' or 'PERMISSIVE', not {mode!r}")
    options = {
        "encoding": "utf-8", "quote": '"', "escape": '"', "multiLine": str(multi_line).lower(),
        "maxCharsPerColumn": str(max_field_chars), "mode": mode,
    }
    reader = spark.read.options(**options).option("header", True)
    # every file's header is held against the first one's: columns in another order are an error, not other values
    table = reader.csv(path)
    if multi_line:
        return _parsed(spark, path, table.columns, options, file_order)
    table = reader.schema(table.schema).option("enforceSchema", False).csv(path)
    if mode == "PERMISSIVE":
        with_raw = table.schema.add(CORRUPT, "string")
        table = reader.option("columnNameOfCorruptRecord", CORRUPT).schema(with_raw).csv(path)
    return with_file_order(table, file_order) if file_order else table


def _parsed(spark: SparkSession, path: str, names: list[str], options: dict[str, str], file_order: str | None) -> DataFrame:
    """The rows of `read_records` under `names`; the first record of each file must be the header."""
    cells = [f"{quoted(n)} STRING" for n in names]
    if options["mode"] == "PERMISSIVE":
        options = {**options, "columnNameOfCorruptRecord": CORRUPT}
        cells.append(f"{CORRUPT} STRING")
    records = csv_records.read_records(spark, path, file_order is not None).withColumnRenamed("row", "place")
    row = F.from_csv("text", ", ".join(cells), options)
    # a repeated name carries its place, one that is empty is made from it
    fits = [
        F.lower(F.coalesce(F.col("row")[n], F.lit(""))).isin({n.lower(), n.lower().removesuffix(str(i)), "" if n == f"_c{i}" else n.lower()})
        for i, n in enumerate(names)
    ]
    wrong = F.raise_error(F.concat(F.lit("a file has another header: "), "text")).cast("boolean")
    is_row = F.when(F.col("top"), F.when(F.forall(F.array(*fits), lambda fit: fit), False).otherwise(wrong)).otherwise(True)
    table = records.withColumn("row", row).where(is_row)
    place = [F.struct("file", "block", F.col("place").alias("row")).alias(file_order)] if file_order else []
    return table.select("row.*", *place)


def read_entity(
    spark: SparkSession,
    path: str,
    entity: str,
    types: Mapping[str, str] | None = None,
    strict_flags: bool = False,
    **options,
) -> DataFrame:
    """A CSV table of a known entity, typed; `types` adds to or replaces the entity's types."""
    if entity not in schemas.ENTITY_TYPES:
        raise ValueError(f"unknown entity {entity!r}; expected one of {sorted(schemas.ENTITY_TYPES)}")
    return apply_types(
        read_text_table(spark, path, **options),
        {**schemas.ENTITY_TYPES[entity], **(types or {})},
        schemas.ENTITY_FLAGS.get(entity, ()),
        strict_flags=strict_flags,
    )


def read_photo_dataset(spark: SparkSession, path: str, **options) -> DataFrame:
    """A written photo dataset: typed, with its rating list parsed."""
    table = read_entity(spark, path, "photo_dataset", **options)
    return table.withColumn("stars_ord", F.from_json("stars_ord", "array<int>"))


def bad_rows(df: DataFrame) -> DataFrame:
    """The malformed rows of a permissive read, as raw text.

    All columns are read, since a scan pruned to the raw text alone does not parse the rows.
    """
    return df.where(F.col(CORRUPT).isNotNull())


def matching_columns(df: DataFrame, pattern: str) -> list[str]:
    """Names of the columns in which `pattern` is found."""
    return [name for name in df.columns if re.search(pattern, name)]
