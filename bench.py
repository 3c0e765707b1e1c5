"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries", "sf"}.
Each query is first run once on the smallest tables (JVM class loading, JIT
and Python worker start-up), then timed on $BENCH_SF_DIR, where its whole
result is written to the no-op sink; the value is the sum of the timed
per-query wall times.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from holecard.plans import queries as q  # noqa: E402
from holecard.session import build_session  # noqa: E402

HEADLINE = [
    "line_prompts", "token_prompts", "method_prompts", "line_candidates", "token_candidates",
    "method_bodies", "split_random_exact", "composite_score", "summary_by_kind",
    "build_log_parse", "pass_at_k", "neighbourhood_tiers", "test_match_pairs",
    "scorecard_summary",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or [n for n in HEADLINE if n in q.QUERIES]
    spark = build_session(f"local[{cpus}]", app_name="holecard-bench",
                          shuffle_partitions=int(cpus) * 2,
                          extra={"spark.driver.memory": "16g"})
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        for name in names:
            q.QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.time()
        df = q.QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
