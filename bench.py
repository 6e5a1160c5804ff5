"""Bench: wall seconds per headline query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs to completion through the ``noop`` sink (every row is
produced, nothing is collected).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from commerce_marts.catalog import QUERIES  # noqa: E402
from commerce_marts.session import get_session  # noqa: E402

HEADLINE = (
    "dedup_order_items", "clean_orders", "surrogate_key_customers", "dim_customers",
    "dim_products", "fact_orders", "int_orders_items_joined", "mart_sales_by_region",
    "mart_product_performance", "mart_delivery_kpis", "revenue_by_state",
    "executive_summary", "on_time_by_state", "profile_summary", "dq_results",
    "warehouse_build",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    keys = sys.argv[1:] or list(HEADLINE)
    spark = get_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_PARTITIONS", "8")))
    # warm-up: JIT and file metadata, not timed
    QUERIES["stg_orders"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for key in keys:
        t0 = time.perf_counter()
        QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[key] = round(time.perf_counter() - t0, 3)
        print(f"# {key}: {times[key]}s", file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_wall_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
