"""Bench: run the headline jobs on $BENCH_SF_DIR with local[$BENCH_CPUS].

Each job is executed in full with the ``noop`` sink (every row computed, none
collected). Prints one JSON line with per-query seconds and their total.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from orderdesk.plans import registry  # noqa: E402
from orderdesk.session import build_session  # noqa: E402

HEADLINE = [
    "tracking_summary", "open_orders", "contact_reminders", "late_reminders", "replies",
    "web_tracking", "insert_absent", "price_requests", "cover_sheet", "cover_flags", "report_check",
    "price_audit", "vendor_new_items", "inactive_cover", "price_check", "order_totals",
    "quote_requests", "dummy_check", "forward_fill", "order_lines_ffill", "lookahead_upc",
    "memo_items", "contact_audit",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus)
    registry.load_all()
    # warm-up: JVM, parquet footers, code generation caches
    registry.run(spark, "tracking_summary", sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        registry.run(spark, name, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus, "spark": spark.version}))
    spark.stop()


if __name__ == "__main__":
    main()
