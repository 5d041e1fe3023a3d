"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the data, BENCH_CPUS the local cores.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from statistics import median

HEADLINE = [
    "dedup_latest", "merge_soft_delete", "merge_hard_delete", "merge_hard_delete_partitioned", "merge_table_soft_delete",
    "merge_table_hard_delete", "dml_update", "dml_delete", "as_of_history", "hive_scan_pruned", "hive_bad_partition",
    "ctas_range_bucket", "clustered_write_roundtrip", "json_unnest", "conform_types", "export_micros_roundtrip", "olap_group",
    "ingest_stream_available_now", "stream_merge", "evolve_append", "sync_direct_users", "sync_landing_users",
    "sync_dated_transactions", "migrate_hive_trips", "storage_after_delete",
]


def main() -> None:
    from tidemark.checks import QUERIES
    from tidemark.session import build_session

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    scratch = tempfile.TemporaryDirectory(prefix="tidemark-bench-")
    spark = build_session(
        "tidemark-bench", master=f"local[{cores}]", shuffle_partitions=cores,
        **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g",
           "spark.checkpoint.dir": scratch.name})
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    times = {}
    for name in sys.argv[1:] or HEADLINE:
        # Of three runs; the first pays for class loading and code generation.
        times[name] = round(median(run(name) for _ in range(3)), 3)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "cpus": cores,
    }))
    spark.stop()
    scratch.cleanup()


if __name__ == "__main__":
    main()
