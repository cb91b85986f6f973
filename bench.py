"""Benchmark the headline queries.

Runs each query at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` (default 8) with a warm session. Each query is executed
to completion with the ``noop`` sink (every row is produced, nothing is
collected to the driver); the reported time per query is the median of
``$BENCH_REPEAT`` runs (default 3; model-fitting queries run once), after one
untimed run (but for the model search, whose code the other fits have warmed
up).

After every query a JSON line with the results so far is printed; the last
line is the whole result, so a run that is stopped keeps what it measured.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from keelson.plans import catalog  # noqa: E402
from keelson.session import local_session  # noqa: E402

HEADLINE = [
    "feature_table",
    "impute_median",
    "string_index",
    "contract_check",
    "split_hash",
    "weighted_f1",
    "drift_report",
    "run_log",
    "score_batch",
    "score_stream",
    "select_best_model",
]
FIT_ONCE = {"select_best_model", "score_batch", "score_stream"}
COLD = {"select_best_model"}


def run(spark, name: str, sf: str) -> float:
    t = time.perf_counter()
    df = catalog.QUERIES[name](spark, sf)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2 if cpus.isdigit() else 16, app="keelson-bench")
    sf_label = os.path.basename(sf.rstrip("/")).replace("sf", "")
    times = {}
    for name in HEADLINE:
        if name not in COLD:  # warm-up: JIT, file listing, Python workers, ML code paths
            run(spark, name, sf)
        n = 1 if name in FIT_ONCE else repeat
        times[name] = round(statistics.median(run(spark, name, sf) for _ in range(n)), 3)
        print(json.dumps({
            "metric": "headline_total_sec",
            "value": round(sum(times.values()), 3),
            "unit": "sec",
            "queries": times,
            "sf": float(sf_label) if sf_label.replace(".", "", 1).isdigit() else sf_label,
            "cpus": cpus,
            "complete": len(times) == len(HEADLINE),
        }), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
