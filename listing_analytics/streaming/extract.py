"""Extraction from a stream of files. The filters hold no state, so the batch operators apply as they are."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from listing_analytics.plans.subset import SubsetSpec, records_for_ids


def read_new_files(spark: SparkSession, folder: str, schema: StructType, source: str = "parquet") -> DataFrame:
    """A stream of the rows of files that arrive in `folder`."""
    return spark.readStream.format(source).schema(schema).load(folder)


def extract_stream(
    records: DataFrame, ids: DataFrame, spec: SubsetSpec, entity: str, out: str, checkpoint: str
) -> StreamingQuery:
    """Append the records of the given businesses to `out`, up to the files present now.

    Run again with the same `checkpoint` to add what has arrived since.
    """
    if spec.limit is not None:
        raise ValueError("a row limit has no meaning on a stream")
    return (
        records_for_ids(records, ids, spec, entity)
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
