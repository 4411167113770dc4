"""Time the headline queries; prints one JSON line. ``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and cores."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "q_subsample", "q_site_filter", "q_membership", "q_membership_shuffled", "q_sample_counts", "q_group_summaries",
    "q_pairwise_d", "q_pairwise_p", "q_flagship", "q_heatmap", "q_volcano", "q_distributions", "q_metric_pca",
    "q_interval_summary", "q_downsample_strat", "q_downsample_uniform", "q_vcf_metrics", "q_results_comparisons",
]


def main() -> None:
    from checks.compare import session
    from checks.queries import REGISTRY

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    # One untimed small query loads classes and starts the executors' threads.
    REGISTRY["q_labels_merge"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        started = time.perf_counter()
        REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
