"""Time the headline queries: one JSON line on the last line of the output.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the local cores. Every
result is read in full, by a write that throws the rows away, and the best of BENCH_RUNS counts.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from listing_analytics.registry import QUERIES  # noqa: E402
from listing_analytics.session import build_session  # noqa: E402
from listing_analytics.staging import clear_stages  # noqa: E402

HEADLINE = (
    "category_match", "regex_filter", "id_semi_filter", "id_anti_filter", "filter_chain", "reviews_for_ids",
    "staged_prefilter", "photo_business_left", "photo_business_outer", "label_ordinal", "value_counts",
    "distinct_profile", "frequency_table", "confusion_matrix", "classification_report", "sample_n_rows",
    "sample_fraction_rows", "sample_by_key", "seeded_shuffle", "split_three_way", "batch_plan", "topk_classes",
    "feature_moments", "vector_featurewise", "image_channel_mean", "csv_round_trip", "business_extract",
    "subset_run", "photo_dataset",
)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "bench", master=f"local[{cpus}]", spark__sql__shuffle__partitions=cpus if cpus.isdigit() else 8,
        spark__driver__memory="8g", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    # the first query pays for the start of the executor threads and the Python workers
    QUERIES["accuracy"](spark, sf).collect()
    seconds = {}
    for name in HEADLINE:
        times = []
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times), 3)
    clear_stages(spark)
    spark.stop()
    scale = re.search(r"sf([0-9.]+)", sf)
    print(json.dumps({
        "metric": "total_query_time", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": float(scale.group(1)) if scale else sf,
    }))


if __name__ == "__main__":
    main()
