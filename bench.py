"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8) the local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

HEADLINE = [
    "table_scan",
    "date_filter",
    "age_bracket",
    "json_extract",
    "render_statement",
    "gold_counts",
    "ingest_csv",
    "ingest_json",
    "ingest_parquet",
    "stream_complete_counts",
    "append_frames",
    "overwrite_partition",
    "clustered_write",
    "delete_where",
    "update_where",
    "merge_upsert",
    "diff_versions",
    "dq_allowed",
    "dq_unique",
    "assign_ids",
    "load_report",
    "compact",
    "zorder",
    "vacuum_candidates",
    "column_stats",
    "maint_plan",
    "sql_step_silver",
    "step_join_aggregate",
    "step_windows",
    "medallion",
]


def main() -> None:
    from lakeops.checks import QUERIES
    from lakeops.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "lakeops-bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="8g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    wanted = sys.argv[1:] or HEADLINE
    QUERIES["table_scan"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # start-up is not measured
    seconds = {}
    for name in wanted:
        start = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
