"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local cores, and
BENCH_QUERIES (comma separated, or "all") picks other queries.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from millrace.queries import QUERIES  # noqa: E402
from millrace.session import build_session  # noqa: E402

HEADLINE = [
    "group_multi_agg", "agg_cube", "salted_agg", "distinct_counts", "word_explode_count",
    "join_inner", "join_full", "join_group", "billing_chain", "having_df",
    "win_row_number", "win_rank", "win_running_sum", "win_top1", "surrogate_key",
    "validate_transactions", "valid_trips", "reconcile_windows", "incremental_upsert",
    "sliding_demand_supply", "surge_rules", "surge_smoothed", "nearest_zone",
    "zone_hour_kpis", "driver_payout", "fact_trips", "fact_partition_pruned", "bench_q1", "features_full",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    spark = build_session("bench", f"local[{cpus}]", log_level="ERROR", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g"})
    # One throw-away query pays for JVM and code generation warm-up.
    QUERIES["group_count"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    spark.stop()
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": Path(sf_dir).name.removeprefix("sf"), "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
