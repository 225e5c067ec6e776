"""Benchmark the headline queries.

Runs on $BENCH_SF_DIR (default /root/testdata/sf0.1) with local[$BENCH_CPUS]
and prints ONE JSON line:
  {"metric": "headline_total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each query is executed in full with the ``noop`` sink (every row is
computed, nothing is collected to the driver).  Build time (which includes
eager checkpoints of iterative stages) counts towards the query.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "trim_user_item_user",
    "join_corated_pairs",
    "sim_cosine",
    "baseline_als",
    "predict_knn_baseline",
    "rec_batch_requests",
    "rec_known_users_top_n",
    "tune_knn_grid",
)
#: the dearest plans, timed apart: `python bench.py --heavy`
HEAVY = (
    "eval_compare_models",
    "eval_cross_validate",
    "baseline_gd",
    "predict_coclustering",
    "predict_slope_one",
    "stream_incremental_pairs",
    "join_corated_pairs_full",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = list(HEAVY) if sys.argv[1:] == ["--heavy"] else sys.argv[1:] or list(HEADLINE)
    from recspark.session import build_session
    from recspark.plans import REGISTRY

    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus))
    # warm the JVM, the parquet reader and the Python workers once on the smallest
    # fixture (not timed): the timed numbers then measure the queries, not start-up
    smoke = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(smoke):
        REGISTRY["rec_top_n"].build(spark, smoke).write.format("noop").mode("overwrite").save()

    times = {}
    for name in names:
        t0 = time.time()
        df = REGISTRY[name].build(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        print(f"{name}: {times[name]}s", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else sf_dir
    print(json.dumps({"metric": "headline_total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
