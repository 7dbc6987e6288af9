"""Training histories: the last epoch and the best one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from listing_analytics.sources.tables import quoted


def last_epoch(history: DataFrame, run: Sequence[str], epoch: str, metrics: Sequence[str]) -> DataFrame:
    """Per run, the metrics of its highest epoch; epochs are unique within a run."""
    last = [F.max_by(quoted(m), quoted(epoch)).alias(m) for m in metrics]
    return history.groupBy(*run).agg(F.max(quoted(epoch)).alias(epoch), *last)


def best_epoch(
    history: DataFrame, model: Sequence[str], metric: str, others: Sequence[str], tie: Sequence[str]
) -> DataFrame:
    """Per model, the row with the lowest `metric`; equal rows are settled by the columns `tie`."""
    rank = F.struct(F.col(quoted(metric)), *[F.col(quoted(t)) for t in tie])
    values = F.struct(*[F.col(quoted(c)) for c in dict.fromkeys([metric, *tie, *others])])
    return (
        history.where(F.col(quoted(metric)).isNotNull())
        .groupBy(*model).agg(F.min_by(values, rank).alias("_best")).select(*model, "_best.*")
    )
