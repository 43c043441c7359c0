"""Benchmark of the headline queries.

Runs each query end to end at ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) on ``local[$BENCH_CPUS]`` and prints ONE JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

A query is executed with the ``noop`` sink: every stage runs, nothing is
collected to the driver. Each query runs ``$BENCH_RUNS`` times (default 2,
nothing cached between runs); the best run is reported, the first run too. Queries that write tables do so under the session's
checkpoint folder and are timed including their writes.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemart.plans import catalog  # noqa: E402
from tidemart.session import build_session  # noqa: E402


HEADLINE = {
    "sales_report": catalog.sales_report,
    "sales_report_daily": catalog.sales_report_daily,
    "asof_join": catalog.asof_join_month,
    "asof_join_union": catalog.asof_join_union,
    "asof_events": catalog.asof_events,
    "merge_guarded": catalog.merge_guarded,
    "merge_delta_to_main": catalog.merge_delta_to_main,
    "latest_order_item_per_day": catalog.latest_order_item_per_day,
    "signed_daily_sum": catalog.signed_daily_sum_q,
    "sales_by_attributes": catalog.sales_by_attributes_q,
    "check_unique": catalog.check_unique_q,
    "sales_transaction_fact": catalog.sales_transaction_fact,
    "replace_partitions": catalog.replace_partitions,
    "product_dim_scd1": catalog.product_dim_scd1,
    "hourly_change_load": catalog.hourly_change_load,
    "stream_upsert_final": catalog.stream_upsert_final,
}


RUNS = int(os.environ.get("BENCH_RUNS", "2"))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = set(sys.argv[1:])
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus, app_name="tidemart-bench",
                          extra={"spark.driver.memory": "16g"})
    # Warm-up (untimed, nothing cached): JIT compilation and first file reads
    # are not charged to whichever query happens to run first.
    catalog.sales_report(spark, sf_dir).write.format("noop").mode("overwrite").save()

    timings: dict[str, float] = {}
    first_runs: dict[str, float] = {}
    for name, query in HEADLINE.items():
        if only and name not in only:
            continue
        runs = []
        for _ in range(RUNS):
            start = time.perf_counter()
            query(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        timings[name] = round(min(runs), 3)
        first_runs[name] = round(runs[0], 3)
    spark.stop()
    match = re.search(r"sf([0-9.]+)$", sf_dir)
    print(json.dumps({
        "metric": "total_sec",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(match.group(1)) if match else sf_dir,
        "cpus": cpus,
        "stat": f"min of {RUNS} runs per query",
        "first_run": first_runs,
    }))


if __name__ == "__main__":
    main()
