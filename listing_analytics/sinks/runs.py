"""Training records: metrics per epoch and one row per run."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from listing_analytics.functions import text
from listing_analytics.operators.history import last_epoch

METRICS = ("accuracy", "val_accuracy", "loss", "val_loss")


def write_epochs(history: DataFrame, path: str, mode: str = "append") -> None:
    """Rows `model, run_id, epoch` with their metrics, in the order of the epochs."""
    history.select("model", "run_id", "epoch", *METRICS).write.mode(mode).partitionBy("model").parquet(path)


def run_rows(history: DataFrame, runs: DataFrame) -> DataFrame:
    """One row per run: its parameters and its last epoch's metrics.

    `runs` has `run_id, model, datetime, epochs, params, results_folder, model_saved`.
    """
    final = last_epoch(history, ["run_id"], "epoch", METRICS)
    return runs.join(final, "run_id", "left").select(
        "model", "datetime", *METRICS, "epochs", "params", "results_folder", "model_saved"
    )


def append_runs(rows: DataFrame, path: str) -> None:
    """Append to the run log; the first write creates it."""
    rows.write.mode("append").parquet(path)


def run_log_text(rows: DataFrame) -> DataFrame:
    """The run log with its parameters as text in key order."""
    return rows.withColumn("params", text.params_text(F.col("params")))
