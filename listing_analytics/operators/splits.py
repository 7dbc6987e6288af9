"""Positional splits and batches over a table with an `ordinal` column."""

from __future__ import annotations

import warnings
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

TRAIN, VALIDATION, VERIFY = "train", "validation", "verify"


@dataclass(frozen=True)
class Split:
    """Fractions held out for verification (the tail) and, of the rest, for validation.

    `validation_from` says at which end of the rest the validation rows are taken.
    """

    verification: float = 0.0
    validation: float = 0.0
    validation_from: str = "tail"

    def __post_init__(self):
        for name in ("verification", "validation"):
            if not 0 <= getattr(self, name) < 1:
                raise ValueError(f"{name} fraction must be in [0, 1): {getattr(self, name)}")
        if self.validation_from not in ("tail", "head"):
            raise ValueError(f"validation_from must be 'tail' or 'head': {self.validation_from!r}")


def _counted(df: DataFrame, total: str | None) -> DataFrame:
    """`df` with its number of rows as `_n`, from the column `total` where it has one."""
    rows = F.col(total) if total else df.agg(F.count(F.lit(1))).scalar()
    return df.withColumn("_n", rows.cast("double"))


def _before_tail(fraction: float):
    """Number of rows before a tail of that fraction of `_n`."""
    return F.floor(F.col("_n") - F.col("_n") * F.lit(float(fraction)))


def split_rows(df: DataFrame, split: Split, ordinal: str = "ordinal", total: str | None = None) -> DataFrame:
    """Add the column `split`: train, validation or verify, by position.

    `total` names a column with the number of rows; without it the rows are counted.
    """
    counted = _counted(df, total).withColumn("_rest", _before_tail(split.verification).cast("double"))
    share = F.col("_rest") * F.lit(float(split.validation))
    if split.validation_from == "tail":
        in_validation = F.col(ordinal) >= F.floor(F.col("_rest") - share)
    else:
        in_validation = F.col(ordinal) < F.floor(share)
    part = (
        F.when(F.col(ordinal) >= F.col("_rest"), VERIFY)
        .when(in_validation, VALIDATION)
        .otherwise(TRAIN)
    )
    return counted.withColumn("split", part).drop("_n", "_rest")


def holdout_rows(df: DataFrame, fraction: float, ordinal: str = "ordinal", total: str | None = None) -> DataFrame:
    """The verification tail alone; the whole table when the rest would be empty."""
    cut = _before_tail(fraction)
    return _counted(df, total).where((cut < 1) | (F.col(ordinal) >= cut)).drop("_n")


def warn_if_empty(df: DataFrame, fraction: float) -> None:
    """Warn when a verification split of `fraction` would leave nothing before it."""
    if int(df.count() * (1 - fraction)) < 1:
        warnings.warn(f"cannot make a verification split of {fraction}", stacklevel=2)


def batch_index(df: DataFrame, size: int, ordinal: str = "ordinal") -> DataFrame:
    """Add the column `batch`: the position divided by the batch size."""
    if size < 1:
        raise ValueError(f"batch size must be positive: {size}")
    return df.withColumn("batch", F.floor(F.col(ordinal) / F.lit(size)))


def batch_steps(df: DataFrame, size: int, split: str = "split") -> DataFrame:
    """Rows and batches of each split; the last batch may be short."""
    if size < 1:
        raise ValueError(f"batch size must be positive: {size}")
    counts = df.groupBy(split).agg(F.count(F.lit(1)).alias("rows"))
    return counts.withColumn("steps", F.ceil(F.col("rows") / F.lit(size)))
