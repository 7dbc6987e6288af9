"""Tables written to the shared folder to cut a plan at a point that must not be recomputed."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from listing_analytics.session import shared_dir

ROOT = "listing_analytics_stages"


def stage_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below this application's part of the shared folder."""
    return f"{_own_root(spark)}/{name}-{uuid.uuid4().hex}"


def _own_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/{ROOT}/{spark.sparkContext.applicationId}"


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write `df` as Parquet and return a scan of the written table.

    Unlike a cached frame the result outlives its executors, and unlike a checkpoint it is
    columnar, so later reads still prune columns and push filters down.
    """
    path = stage_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_stages(spark: SparkSession) -> None:
    """Delete the tables that this application has staged; those of others stay."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(_own_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
