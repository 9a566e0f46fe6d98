"""Seconds per query on the generated tables; prints one JSON line.

Environment: BENCH_SF_DIR, BENCH_CPUS, BENCH_RUNS (measured runs after one
warm-up, median is reported), BENCH_QUERIES (comma-separated subset),
BENCH_SHAPES=1 (also time the same results in the three-join, inner-plus-anti
and one-partition-window shapes, see tests/plain_shapes.py).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cases import CASES  # noqa: E402
from millrace.scratch import release  # noqa: E402
from millrace.session import local_session  # noqa: E402

# One query per family of operators.
HEADLINE = [
    "lookup_split", "lookup_match", "lookup_reject", "lookup_cascade", "lookup_chain_rejects", "refund_netting", "latest_per_customer",
    "latest_flag", "surrogate_keys", "upsert_whole_rows", "upsert_changed_rows", "scd2_segment", "scd1_attributes",
    "dim_snapshot_merge", "slice_replace", "reload_removal", "mtd_supersede", "first_event_after",
    "resolve_member_attribute", "flag_propagation", "transfer_diff", "business_day", "daily_sales_fact",
    "feed_fuel_fact", "transaction_load", "card_registration", "metrics_scalar", "metrics_grouped", "metrics_reconcile",
    "file_keys", "card_profile", "versioned_overwrite", "partition_upsert",
]


def seconds(run, spark, folder: str) -> float:
    start = time.perf_counter()
    run(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    wanted = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINE
    spark = local_session(cpus, "bench", partitions=cpus, memory="16g")
    work = {name: CASES[name].run for name in wanted}
    if os.environ.get("BENCH_SHAPES") == "1":
        from tests.plain_shapes import SHAPES
        work |= {f"plain_{name}": run for name, run in SHAPES.items()}
    times = {}
    for name, run in work.items():
        seconds(run, spark, folder)
        times[name] = round(statistics.median(seconds(run, spark, folder) for _ in range(runs)), 3)
    total = round(sum(times[name] for name in wanted), 3)
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": times,
                      "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "cpus": cpus, "runs": runs}))
    release(spark)
    spark.stop()


if __name__ == "__main__":
    main()
