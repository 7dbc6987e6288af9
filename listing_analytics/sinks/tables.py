"""CSV tables, line lists and class maps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F, types as T


def text_safe(df: DataFrame) -> DataFrame:
    """Array, map and struct columns as JSON text, since CSV has no nested values."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    return df.select([
        (F.to_json(F.col(f"`{f.name}`")) if isinstance(f.dataType, nested) else F.col(f"`{f.name}`")).alias(f.name)
        for f in df.schema.fields
    ])


def write_csv(df: DataFrame, path: str | None, mode: str = "overwrite") -> int | None:
    """Write with a header and return the number of rows; without a path nothing is written."""
    if path is None:
        return None
    rows = Observation()
    (
        text_safe(df).observe(rows, F.count(F.lit(1)).alias("rows"))
        .write.mode(mode)
        .option("header", True)
        .option("encoding", "utf-8")
        .option("quote", '"')
        .option("escape", '"')
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return rows.get["rows"]


def write_parquet(df: DataFrame, path: str | None, mode: str = "overwrite") -> int | None:
    """The same as Parquet, which later scans can prune and split."""
    if path is None:
        return None
    rows = Observation()
    df.observe(rows, F.count(F.lit(1)).alias("rows")).write.mode(mode).parquet(path)
    return rows.get["rows"]


def write_lines(df: DataFrame, path: str | None, column: str, mode: str = "overwrite") -> None:
    """One value per line."""
    if path is not None:
        df.select(F.col(f"`{column}`").cast("string")).write.mode(mode).text(path)


def class_map_json(classes: DataFrame) -> DataFrame:
    """One JSON object `{"0": "1_0", ...}` from the rows `class_idx, cat` of a class map."""
    entries = F.array_sort(F.collect_list(F.struct("class_idx", "cat")))
    pairs = F.transform(entries, lambda e: F.struct(e["class_idx"].cast("string"), e["cat"]))
    return classes.agg(F.to_json(F.map_from_entries(pairs)).alias("value"))


def write_class_map(classes: DataFrame, path: str, mode: str = "overwrite") -> None:
    class_map_json(classes).write.mode(mode).text(path)
