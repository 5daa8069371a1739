"""Time the registered queries and print one JSON line.

BENCH_SF_DIR   folder of tables (default sf0.1)
BENCH_CPUS     cores (default 8)
BENCH_RUNS     timed runs per query after one warm-up (default 1)
BENCH_QUERIES  comma separated parts of names, or "all"; default the headline queries
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallyframe.plans import all_queries  # noqa: E402
from tallyframe.session import local_session  # noqa: E402


HEADLINE = (
    "open_order_aging", "star_denormalize", "left_equi_join", "left_equi_join_salted", "full_outer_join", "theta_range_on",
    "apply_top1", "apply_aggregate", "join_first_last_state", "self_join_min_due", "join_back_max_group", "group_sum",
    "conditional_sum", "conditional_max_pivot", "sum_distinct", "string_agg_labelled", "first_per_group", "latest_per_key",
    "group_flag_over", "overlapping_branch_union", "anti_join_isnull", "filter_between", "filter_in_long_list",
    "lifecycle_label", "threshold_segment_by_year", "date_differences", "number_conversions", "text_clean_control_chars",
    "json_deep_find", "json_nested_string_chain", "json_envelope_records", "load_upsert_replace", "load_hash_validity",
    "stream_append_increment", "job_phone_directory", "job_loan_originations", "job_collections_mtd",
    "job_portfolio_aging", "job_portfolio_history", "job_teller_transactions", "job_application_wide",
)


def chosen(names) -> list[str]:
    wanted = os.environ.get("BENCH_QUERIES", "")
    if wanted == "all":
        return list(names)
    if wanted:
        parts = [p for p in wanted.split(",") if p]
        return [n for n in names if any(p in n for p in parts)]
    return [n for n in names if n in HEADLINE]


def run(query, spark, folder) -> float:
    """Seconds to build and fully compute one query; no row is brought to the driver."""
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = local_session(cpus, shuffle_partitions=int(cpus))
    times: dict[str, float] = {}
    failed: dict[str, str] = {}
    queries = all_queries()
    for name in chosen(queries):
        query = queries[name]
        try:
            run(query, spark, folder)
            times[name] = round(statistics.median(run(query, spark, folder) for _ in range(runs)), 3)
        except Exception as e:  # a failing query must not hide the others
            failed[name] = f"{type(e).__name__}: {str(e)[:200]}"
    line = {
        "metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "cpus": int(cpus),
    }
    if failed:
        line["failed"] = failed
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
