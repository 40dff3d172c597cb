"""Headline-query benchmark.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Runs each headline query to completion (``write.format("noop")`` forces every row without collecting)
and prints one JSON line: {"metric", "value" (total seconds), "unit", "queries": {name: seconds}, "sf"}.
"""
from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "top_users", "user_totals", "item_sets", "canonicalize_ids", "top_n_per_user",
    "degree_distribution", "connected_components", "articulation_points", "closeness_centrality",
    "heterogeneous_graph", "move_gain",
    "word_counts", "vocabulary", "discriminative_features", "context_pairs", "classify_lexicon",
    "nearest_neighbors", "analogy_accuracy",
    "kernel_regression", "leverage_cooks", "residual_autocorrelation",
    "greedy_best_bid", "describe_stats", "equal_width_bins",
    "als_overlap_score", "rank_sweep", "stream_running_totals",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    from quarry.session import build_session
    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2, app_name="quarry-bench")
    if not spark.sparkContext.getCheckpointDir() and not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="quarry-bench-ckpt-"))
    from quarry.plans import REGISTRY
    times = {}
    for name in names:
        q = REGISTRY[name]
        t0 = time.time()
        try:
            q.fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.time() - t0, 3)
        except Exception as e:  # noqa: BLE001
            print(f"# {name} failed: {type(e).__name__}: {str(e)[:200]}", file=sys.stderr)
            times[name] = None
    m = re.search(r"sf([0-9.]+)", sf_dir)
    total = round(sum(v for v in times.values() if v is not None), 3)
    print(json.dumps({"metric": "headline_total_seconds", "value": total, "unit": "sec", "queries": times,
                      "sf": float(m.group(1)) if m else sf_dir, "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
