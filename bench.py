"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full with the ``noop`` sink (no collect to the
driver) and timed; prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tarmac.plans.registry import load_all  # noqa: E402
from tarmac.session import build_session  # noqa: E402

HEADLINE = [
    "late_share_by_carrier", "histogram", "ecdf", "box_by_carrier", "heatmap_masked", "daily_trend",
    "cancel_rate_route", "kpis", "describe_by_carrier", "shape", "kruskal_carrier", "dunn_carrier",
    "mann_whitney", "spearman_distance", "chi2_carrier_cancel", "welch_weekend", "latest_notice",
    "upsert_notices_single", "mid_ranks", "chronological_split", "fold_scores", "run_summary",
    "features", "scale_robust", "knn_exact", "page_links", "stream_upsert",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(app="tarmac-bench")
    queries, _ = load_all()
    # warm-up (JVM, codegen caches): not timed
    queries["kpis"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
