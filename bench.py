"""Wall time of the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS the local cores. Each
query runs once to warm up and then once on the clock, with its whole result computed.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from riskengine.queries import QUERIES  # noqa: E402
from riskengine.session import build_session  # noqa: E402

HEADLINE = [
    "flagship",
    "compute_features",
    "time_split",
    "sample_n",
    "statistical_profile",
    "class_effect_size",
    "amount_outliers",
    "auc_pr",
    "auc_roc",
    "optimal_threshold",
    "candidate_thresholds",
    "slice_by_amount",
    "bootstrap_summary",
    "drift_ks",
    "drift_wasserstein",
    "drift_decision",
    "drift_by_window",
    "recon_error",
    "promotion_gate",
    "register_versions",
    "batch_score",
    "scoring_stats",
    "raw_zone_ingest",
    "stream_score",
]


def run(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    partitions = cpus if cpus.isdigit() else "8"
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=partitions,
        spark__ui__enabled="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in names:
        run(spark, name, folder)
        seconds[name] = round(run(spark, name, folder), 3)
    print(
        json.dumps(
            {
                "metric": "total wall time of the headline queries, warm",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
