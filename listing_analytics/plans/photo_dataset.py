"""The labelled photo dataset: photos with the ratings of their business and their file attributes."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, functions as F

from listing_analytics import schemas
from listing_analytics.operators import filters, images, joins, profile, projections, sampling
from listing_analytics.plans.subset import SubsetSpec, business_extract, records_for_ids
from listing_analytics.sinks import tables as sinks
from listing_analytics.sources.tables import read_photo_dataset
from listing_analytics.staging import stage

ATTRIBUTE_NAMES = ("photo_file", "format", "width", "height", "mode")


@dataclass(frozen=True)
class Sample:
    """A sample size (rows or keys from 1 upwards, a fraction below) and what is sampled."""

    size: float
    select_on: str = "all"
    seed: int = 1


def labelled_photos(
    business: DataFrame,
    photos: DataFrame,
    spec: SubsetSpec = SubsetSpec(),
    ids: Iterable | DataFrame | None = None,
    sample: Sample | None = None,
    counts: Observation | None = None,
) -> DataFrame:
    """Photos with the labels of their business; photos of an unknown business keep empty labels.

    Businesses are selected under the rule id `biz_photo`, photos under `pin`. `counts` counts the photos read and
    those dropped without an id, while the result is read.
    """
    rated = projections.add_labels(business_extract(business, spec, ids=ids, rule_id="biz_photo")).select(
        spec.key, "stars", "stars_cat", "stars_ord", "stars_num"
    )
    # no photo, no row: this is the outer join without the businesses that have no photo
    if counts is not None:
        photos = photos.observe(counts, F.count(F.lit(1)).alias("loaded"), F.count_if(F.col("photo_id").isNull()).alias("dropped"))
    photos = photos.where(F.col("photo_id").isNotNull())
    if isinstance(ids, DataFrame) and spec.limit is None:
        # ids and ratings are joined first and written, as one table with a row per business. Photos
        # then meet it in a single join of two plain inputs, in which a hot business can be split;
        # in a chain of joins on one key it could not
        ratings = stage(filters.distinct_ids(ids, spec.key).join(rated, spec.key, "left"), "ratings")
        joined = joins.attach(records_for_ids(photos, None, spec, "photo"), ratings, spec.key, "inner")
    else:
        joined = joins.attach(records_for_ids(photos, ids, spec, "photo"), rated, spec.key)
    if sample is not None:
        joined = sampling.sample(stage(joined, "photos"), sample.size, sample.select_on, "photo_id", seed=sample.seed)
    return joined


def photo_dataset(
    business: DataFrame,
    photos: DataFrame,
    files: DataFrame,
    extensions: list[str],
    spec: SubsetSpec = SubsetSpec(),
    ids: Iterable | DataFrame | None = None,
    sample: Sample | None = None,
    unmatched: str = "error",
    counts: Observation | None = None,
) -> DataFrame:
    """The dataset's columns for every labelled photo.

    `files` has `stem, ext, photo_file` and either the file's bytes as `content` or its attributes
    `format, width, height, mode`.
    """
    labelled = labelled_photos(business, photos, spec, ids, sample, counts)
    if "content" in files.columns:
        # attributes are read where the file is, so that no file content is shuffled; files of other
        # photos may be unreadable
        files = images.image_attributes(files, unreadable="keep")
    dataset = joins.match_files(labelled, files, extensions, unmatched).select(*schemas.PHOTO_DATASET_COLUMNS)
    return images.require_readable(dataset)


def dataset_profile(dataset: DataFrame) -> dict[str, DataFrame]:
    """Ranges, counts and distinct values of a dataset's columns."""
    return {
        "range": profile.column_range(dataset, "width", "height"),
        "width": profile.value_counts(dataset, "width"),
        "height": profile.value_counts(dataset, "height"),
        "values": profile.distinct_values(dataset, "format", "mode", "stars", "stars_cat", "stars_num"),
        "stars_ord": profile.distinct_of(dataset, "stars_ord"),
    }


def write_photo_dataset(dataset: DataFrame, path: str, ids_path: str | None = None) -> int:
    """Write the dataset as CSV, its rating lists as JSON text, and its distinct business ids."""
    rows = sinks.write_csv(dataset, path)
    if ids_path is not None:
        sinks.write_lines(profile.distinct_of(dataset, "business_id"), ids_path, "business_id")
    return rows


@dataclass(frozen=True)
class DatasetReport:
    """Photos read, dropped without an id and written, and the profile of what was written."""

    loaded: int
    dropped: int
    written: int
    profile: dict[str, DataFrame]


def write_with_report(dataset: DataFrame, counts: Observation, path: str, ids_path: str | None = None) -> DatasetReport:
    """Write the dataset of `photo_dataset(..., counts=counts)`, by business and photo id; its rows are made once.

    The files lie in this order: a row's place in them is its place in the dataset. The counts come from the writing job; ids and profile are read from the written table.
    """
    order = ("business_id", "photo_id")
    # range partitions are drawn from a sample, which would make the rows a second time
    made = stage(dataset, "dataset")
    written = sinks.write_csv(made.repartitionByRange(*order).sortWithinPartitions(*order), path)
    table = read_photo_dataset(dataset.sparkSession, path)
    if ids_path is not None:
        sinks.write_lines(profile.distinct_of(table, "business_id"), ids_path, "business_id")
    return DatasetReport(counts.get["loaded"], counts.get["dropped"], written, dataset_profile(table))


def resize_photos(dataset: DataFrame, pictures: DataFrame, size: int | tuple[int, int]) -> DataFrame:
    """Letterboxed pictures of the dataset's photos; photos without a picture are left out."""
    return resize_photo_sets(dataset, pictures, [size]).drop("size")


def resize_photo_sets(dataset: DataFrame, pictures: DataFrame, sizes: Sequence[int | tuple[int, int]]) -> DataFrame:
    """The same for several sizes, from one pass over the pictures."""
    wanted = filters.keep_ids(pictures, dataset.select(F.col("photo_id").alias("stem")), "stem")
    return images.letterbox_sets(wanted, sizes)
