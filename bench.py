"""Time the headline queries and print one JSON line.

Reads BENCH_SF_DIR (default /root/testdata/sf0.1) on local[BENCH_CPUS]. Each query
runs BENCH_RUNS times (default 2), building and planning included; the best time
counts, so that the first one warms up the JVM.
"""

from __future__ import annotations

import json
import os
import time

from replygauge.plans import catalog
from replygauge.session import local_session

HEADLINE = [
    "text_profile",
    "rule_classify",
    "ticket_features",
    "ref_coverage",
    "hard_facts",
    "summary_form",
    "shorthand",
    "render_prompt",
    "parse_reply",
    "consolidated",
    "model_stage",
    "verify_report",
    "audit_scores",
    "score_histogram",
    "gate_rates",
    "segment_means",
    "judge_agreement",
    "run_regression",
    "policy_bands",
    "weekly_scores",
    "stage_loss",
    "csv_roundtrip",
    "stream_weekly",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    spark.sparkContext.setLogLevel("OFF")
    spark.range(1000).count()
    seconds = {}
    for name in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(","):
        times = []
        for _ in range(int(os.environ.get("BENCH_RUNS", "2"))):
            start = time.perf_counter()
            catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times), 3)
    print(json.dumps({
        "metric": "total seconds of the headline queries, best run of each",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
