"""The jobs from files to files: subset extraction, the photo dataset, resized photos."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from listing_analytics.operators import filters, images
from listing_analytics.plans import photo_dataset as datasets, subset as subsets
from listing_analytics.sinks import tables as sinks
from listing_analytics.sources import documents, lists, photo_folder as photo_folder_source, photos, tables

FILE_ORDER = "file_order"

# Extensions of a photo's file, in the order in which they are tried.
EXTENSIONS = (".jpg", ".jpeg", ".png", ".gif", ".bmp")


def read_tables(
    spark: SparkSession, paths: Mapping[str, str], nrows: int | None = None, ordered: bool = False, **options
) -> dict[str, DataFrame]:
    """The CSV tables of these entities; of each the first `nrows` in the order of the file.

    `ordered` keeps the column `file_order` for later limits.
    """
    out = {}
    for entity, path in paths.items():
        table = tables.read_entity(
            spark, path, entity, file_order=FILE_ORDER if ordered or nrows is not None else None, **options
        )
        if nrows is not None:
            table = filters.first_rows(table, nrows, FILE_ORDER)
        out[entity] = table if ordered or nrows is None else table.drop(FILE_ORDER)
    return out


def extract_subset(
    spark: SparkSession,
    spec: subsets.SubsetSpec,
    paths: Mapping[str, str],
    out: str,
    categories_json: str | None = None,
    category_list: str | None = None,
    id_list: str | None = None,
    nrows: int | None = None,
    columnar: bool = False,
    **options,
) -> dict[str, int]:
    """Write the subset of the tables in `paths` (entity to CSV) below `out`; rows per table.

    Categories come from a category tree (`spec.parent`, `spec.exclude`) or from a list, or the
    businesses from an id list. A limit in `spec` counts rows in the order of the files.
    """
    if spec.limit is not None:
        spec = replace(spec, order={**{e: (FILE_ORDER,) for e in paths}, **spec.order})
    loaded = read_tables(spark, paths, nrows, ordered=spec.limit is not None, **options)
    subset = subsets.run_subset(
        spec,
        business=loaded.pop("business", None),
        tree=documents.read_categories(spark, categories_json) if categories_json else None,
        categories=lists.read_lines(spark, category_list, "category") if category_list else None,
        ids=lists.read_lines(spark, id_list, spec.key) if id_list else None,
        **loaded,
    )
    if spec.limit is not None:
        business = None if subset.business is None else subset.business.drop(FILE_ORDER)
        subset = subsets.Subset(business, subset.ids, {e: d.drop(FILE_ORDER) for e, d in subset.records.items()})
    if categories_json:
        titles = filters.category_titles(documents.read_categories(spark, categories_json), spec.parent, spec.exclude)
        sinks.write_lines(titles, f"{out}/categories", "title")
    return subsets.write_subset(subset, out, columnar)


def build_photo_dataset_report(
    spark: SparkSession,
    business_csv: str,
    photo_csv: str,
    photo_folder: str,
    out: str,
    spec: subsets.SubsetSpec = subsets.SubsetSpec(),
    id_list: str | None = None,
    sample: datasets.Sample | None = None,
    extensions: tuple[str, ...] = EXTENSIONS,
    ids_out: str | None = None,
    **options,
) -> datasets.DatasetReport:
    """Write the labelled photo dataset as CSV, and its business ids; the report has the number of photos."""
    loaded = read_tables(spark, {"business": business_csv, "photo": photo_csv}, **options)
    counts = Observation()
    dataset = datasets.photo_dataset(
        loaded["business"], loaded["photo"], photos.read_photos(spark, photo_folder, extensions).drop("path"),
        list(extensions), spec, ids=lists.read_lines(spark, id_list, spec.key) if id_list else None, sample=sample,
        counts=counts,
    )
    return datasets.write_with_report(dataset, counts, out, ids_out)


def build_photo_dataset(*args, **options) -> int:
    """`build_photo_dataset_report`, of which only the number of photos written is returned."""
    return build_photo_dataset_report(*args, **options).written


def _sound_pictures(spark: SparkSession, photo_folder: str, unreadable: str) -> DataFrame:
    if unreadable not in ("error", "drop"):
        raise ValueError(f"unreadable must be 'error' or 'drop', not {unreadable!r}")
    pictures = photos.read_pictures(spark, photo_folder, drop_invalid=unreadable == "drop")
    named = F.concat(F.lit("cannot read picture "), "photo_file")
    return pictures.where(F.when(F.col("width") <= 0, F.raise_error(named).cast("boolean")).otherwise(True))


def resize_photo_set(
    spark: SparkSession, dataset_csv: str, photo_folder: str, size: int | tuple[int, int], out: str,
    unreadable: str = "error",
) -> int:
    """Write the letterboxed pictures of a dataset's photos as a table; the number of pictures.

    A picture that cannot be read ends the job; `unreadable="drop"` leaves it out of the table and the number.
    """
    pictures = _sound_pictures(spark, photo_folder, unreadable)
    return sinks.write_parquet(datasets.resize_photos(tables.read_photo_dataset(spark, dataset_csv), pictures, size), out)


def resize_photo_files(
    spark: SparkSession, dataset_csv: str, photo_folder: str, sizes: Sequence[int | tuple[int, int]], out: str,
    unreadable: str = "error",
) -> int:
    """Write the letterboxed pictures as PNG files, those of each size in a folder of its name; the number of files.

    All sizes come from one pass over the pictures. The files are there when the whole job has succeeded, or none of them.
    """
    pictures = _sound_pictures(spark, photo_folder, unreadable)
    boxed = datasets.resize_photo_sets(tables.read_photo_dataset(spark, dataset_csv), pictures, sizes)
    files, written = images.as_png(boxed), Observation()
    named = files.withColumn("photo_file", F.concat_ws("/", "size", "photo_file")).select("photo_file", "content")
    photo_folder_source.write_folder(named.observe(written, F.count(F.lit(1)).alias("rows")), out)
    return written.get["rows"]
