"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 2: the
fastest run of each query counts, after one untimed warm-up query).
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from verification.compare import local_session  # noqa: E402
from verification.queries import QUERIES  # noqa: E402

HEADLINE = (
    "event_composition", "relative_frequencies", "wide_frequencies", "frequencies_with_metadata",
    "count_table", "subject_table", "load_tables", "input_violations", "sample_metadata",
    "comparison_cohort", "baseline_cohort", "subjects_by_response", "cohort_profile",
    "scope_statistics", "mann_whitney_test", "welch_t_test", "boxplots", "boxplots_by_time",
    "overview", "explore_frequencies", "whole_study",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        start = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.time() - start

    once("event_composition")
    seconds = {name: round(min(once(name) for _ in range(runs)), 3) for name in HEADLINE}
    sf = Path(sf_dir).name.removeprefix("sf")
    print(json.dumps({
        "metric": "headline_query_seconds", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()
