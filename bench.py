"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. ``BENCH_ALL=1`` times every query.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from trialmill.plans import catalog  # noqa: E402
from trialmill.session import build_session  # noqa: E402

HEADLINE = (
    "variant_summary",
    "ab_analysis",
    "welch_ttest",
    "fisher_exact",
    "latest_runs",
    "degradation_by_engine",
    "score_variance",
    "gate_policy",
    "scan_gate",
    "review_gate",
    "scorecard_verdict",
    "certification_levels",
    "pairwise_outcome",
    "case_rewards",
    "task_results",
    "security_findings",
    "unfinished_content",
    "broken_references",
    "circular_references",
    "validation_errors",
    "trajectory_steps",
    "token_usage",
    "trial_files",
    "stored_reports",
    "new_runs_only",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(cpus, "bench")
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    registered = catalog.queries()
    names = list(registered) if os.environ.get("BENCH_ALL") else HEADLINE
    times = {}
    for name in names:
        start = time.perf_counter()
        registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    found = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(found.group(1)) if found else None,
            }
        )
    )


if __name__ == "__main__":
    main()
