"""Time the headline queries: ``BENCH_SF_DIR`` on ``local[BENCH_CPUS]``, one JSON line on stdout.

Each query runs completely into a sink that discards rows. It runs twice and the better time counts, so that the
numbers are about the work and not about the compiler warming up; ``first`` has the cold times.
"""

from __future__ import annotations

import json
import os
import sys
import time

from sparkwarden.plans.queries import REGISTRY
from sparkwarden.session import build_session

HEADLINE = [
    "parse_log_lines",
    "enrich_events",
    "sessionize_gap",
    "sessionize_hot_source",
    "session_events_kept",
    "session_events_hot_source",
    "sessions_written",
    "rule_scores",
    "riskiest_sessions",
    "score_labels",
    "top_suspicious",
    "timeline_5min",
    "timeline_intensity",
    "detection_eval_proxy",
    "vector_topk",
    "vector_topk_scan",
    "vector_topk_cells",
    "lof_scores",
    "isolation_forest_scores",
    "detect_forest",
    "session_technique_mapping",
    "mapping_eval_proxy",
    "map_sessions_text",
    "technique_mitigations",
    "technique_texts",
    "ingested_sessions",
    "session_texts",
    "eval_report_proxy",
    "session_search",
    "lof_duplicates",
    "detect_lof",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    best, first = {}, {}
    for name in names:
        times = []
        for _ in range(2):
            start = time.perf_counter()
            REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(round(time.perf_counter() - start, 3))
        best[name], first[name] = min(times), times[0]
        print(f"{name:32s} {times}", file=sys.stderr, flush=True)
    spark.stop()
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    result = {"metric": "total_time", "value": round(sum(best.values()), 3), "unit": "sec", "queries": best}
    print(json.dumps({**result, "first": first, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))


if __name__ == "__main__":
    main()
