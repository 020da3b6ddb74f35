"""Warm wall time of the headline queries; prints one JSON line.

BENCH_SF_DIR, BENCH_CPUS and BENCH_RUNS select the data, the cores and the number of timed runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from quadrivium import workloads
from quadrivium.session import local_session

HEADLINE = [
    "clean_text", "pronoun_neutralise", "text_properties", "feedback_ingest", "new_documents_anti", "enrichment_left_join",
    "vector_search", "course_matches_subject", "full_info_rows", "retrieve_context", "latest_per_session", "apply_feedback",
    "drift_thresholds_batch", "drift_band", "drift_mean_distance", "drift_text_properties", "dbscan_labels", "density_drift",
    "bias_report", "lexicon_scores", "sample_counts", "order_split", "chat_jsonl", "rouge_n", "bleu", "rouge_l_sum",
]


def seconds(spark, query, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    queries = workloads.queries()
    times = {}
    for name in names:
        seconds(spark, queries[name], sf_dir)
        times[name] = round(statistics.median(seconds(spark, queries[name], sf_dir) for _ in range(runs)), 3)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
