"""Time the headline queries; prints one JSON line.

Every query starts without the stages of the queries before it, so its seconds cover all the work from the source tables to
the last row (written to a sink that keeps nothing). One small untimed query warms the JVM up.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ringsight import queries  # noqa: E402
from ringsight.session import local_session  # noqa: E402

HEADLINES = (
    "rule_scores",
    "account_edges",
    "account_components",
    "component_summary",
    "ring_scores",
    "fused_scores",
    "evaluation_table",
    "live_action_totals",
    "account_communities",
    "model_evaluation",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = local_session(cores, "ringsight-bench")
    queries.REGISTRY["bad_outcomes"](spark, sf_dir).collect()

    seconds: dict[str, float] = {}
    for name in HEADLINES:
        queries.forget_runs()
        start = time.perf_counter()
        queries.REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    rows = queries.fixtures.transactions(spark, sf_dir).count()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
                "cores": int(cores) if cores.isdigit() else cores,
                "transactions": rows,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
