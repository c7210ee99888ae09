"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR  folder of the tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
"""

from __future__ import annotations

import json
import os
import sys
import time

from alertweave import plans
from alertweave.session import local_session

HEADLINE = [
    "flagship_incidents",
    "w1_latest_alerts",
    "w3_classify_duplicates",
    "sequence_features_one_pass",
    "a3_dedup_report",
    "e1_fold_enrichments",
    "e4_e5_current_enrichments",
    "e10_extract",
    "e13_map_alerts",
    "j11_map_lookup",
    "j13_apply_maintenance",
    "c3_sessionize",
    "c4_gate_visibility",
    "c9_name_incidents",
    "a4_incident_rollup",
    "c10_resolve_incidents",
    "t1_query_incidents_page",
    "a9_spammy_alerts",
    "a10_field_catalog",
    "s12_apply_incident_ops",
    "st1_pipeline_stored_alerts",
    "w13_throttle",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, "bench")
    queries = plans.load()
    # start the JVM's code paths and the Python workers before the clock runs
    queries["w1_latest_alerts"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "master": f"local[{cpus}]",
        "runs": "one per query, warm session",
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
