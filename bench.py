"""Benchmark: build the warehouse and run the headline queries.

Runs at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on ``local[$BENCH_CPUS]``
and prints one JSON line.  Pipeline stages (history tables, facts) are timed
on their own; each query is then forced in full with the ``noop`` sink, so
no result is collected to the driver.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tessera.plans.registry import QUERIES  # noqa: E402
from tessera.plans.warehouse import Warehouse  # noqa: E402
from tessera.session import build_session  # noqa: E402

HEADLINE = [
    "monthly_revenue_by_currency", "top_trucks_by_revenue", "top_locations_by_revenue", "kpi_totals",
    "monthly_trend_by_key", "sales_by_hour_and_day", "fact_for_one_truck", "best_item_on_sunday",
    "tagged_header", "quarantine_header", "rule_counts", "dwh_header", "dwh_detail", "sales_line",
    "scd1_upsert", "scd2_tracked", "deleted_keys", "snapshot_diff", "as_of_version", "version_history",
    "hash_reconcile", "lineage_downstream", "lineage_impact", "audit_summary", "audit_recent",
    "scd2_stream", "ingest_incremental", "clustered_write", "fct_temporal_left", "scd2_refresh", "fact_merge",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    spark.sparkContext.setLogLevel("OFF")
    timings: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.time()
        fn()
        timings[name] = round(time.time() - t0, 3)

    w = Warehouse.of(spark, sf_dir)
    timed("build_history", w.build_history)
    timed("build_facts", w.build_marts)
    for name in names:
        timed(name, lambda n=name: QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save())
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "warehouse_build_plus_queries_wall", "value": round(sum(timings.values()), 3),
                      "unit": "sec", "queries": timings, "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
