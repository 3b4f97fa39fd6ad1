"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the table folder (default /root/testdata/sf0.1) and BENCH_CPUS the cores to use (default 8). Every
query is run to completion into a sink that drops the rows: once to warm up, then timed as the best of two.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tallyframe.session import local_session  # noqa: E402
from tallyframe.suite import QUERIES  # noqa: E402

HEADLINE = [
    "mart_resolution_time", "mart_duplicate_ratio", "mart_volume_by_era", "repeat_within_window", "stage_requests",
    "dim_location", "fact_requests", "asof_join_era", "scd2_snapshot", "upsert_by_key", "upsert_dup_batch",
    "versioned_merge", "incremental_fact", "dq_report", "token_counts_clean", "similar_by_tags", "tag_common",
    "ordinal_ranks", "grouped_members", "median_by_group", "merge_duplicates", "count_buckets", "column_profile",
    "restock", "predicates_mix", "csv_parse",
]


def timed(spark, name: str, sf_dir: str) -> float:
    began = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")), "bench")
    wanted = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in wanted:
        timed(spark, name, sf_dir)
        seconds[name] = round(min(timed(spark, name, sf_dir) for _ in range(2)), 3)
    found = re.search(r"sf([0-9.]+)$", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": float(found.group(1)) if found else None,
    }))


if __name__ == "__main__":
    main()
