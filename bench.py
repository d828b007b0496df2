"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) set the input.
Every query runs once untimed on the smallest tables to warm the session up, then once
timed with all its output rows computed.
"""

from __future__ import annotations

import json
import os
import time

from checks import QUERIES
from raterscope.session import local_session

HEADLINE = [
    "audit_workflow_summary",
    "audit_rater_label_summary",
    "audit_job_label_summary",
    "audit_error_contribution",
    "audit_incorrect_sample",
    "multi_consensus",
    "multi_workflow_summary",
    "multi_rater_label_summary",
    "multi_job_label_summary",
    "multi_error_contribution",
    "outcome_workflow_summary",
    "outcome_job_label_summary",
    "outcome_rubric_detail",
    "normalize_decision_json",
    "normalize_auditor_keyed_json",
    "normalize_long_audit",
    "normalize_outcome_wide",
    "infer_rubric_penalties",
    "market_dashboard_rater",
    "contributor_rollup",
    "catalog_labels",
]


def run(spark, name: str, sf_dir: str) -> float:
    start = time.time()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.time() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    spark.sparkContext.setLogLevel("ERROR")
    warm_dir = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    timings = {}
    for name in HEADLINE:
        if os.path.isdir(warm_dir):
            run(spark, name, warm_dir)
        timings[name] = round(run(spark, name, sf_dir), 3)
    result = {
        "metric": "headline_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
