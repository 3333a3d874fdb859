"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS the local cores. Each
query runs to a no-op sink twice and the faster run counts, so that code generation and file
listing of the first run are left out alike for all.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from gridsight.catalog import QUERIES  # noqa: E402
from gridsight.session import local_session  # noqa: E402

HEADLINE = [
    "ibc_crm_ageing_dim", "ibc_all_dim", "pmt_crm_ageing_dim", "ibc_oms_ageing_dim", "consumer_dim",
    "consumer_totals", "crm_consumer_summary", "crm_date_summary", "oms_ibc_month",
    "oms_feeder_date", "date_ibc_crm_oms", "fact_billing_and_recovery", "fact_network_and_losses",
    "recovery_percentage", "weekly_rollup", "kpi_fact", "feeder_week_panel", "sliding_sequences",
    "latest_sequence", "lag_features", "has_future_event_days", "threshold_sweep_weekly",
    "encode_categories", "index_key", "clean_billing_extract", "monthly_load", "idempotent_append",
    "file_arrival_ingest",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    shared = {"spark.checkpoint.dir": tempfile.mkdtemp(prefix="gridsight-bench-")}
    spark = local_session("bench", cpus, int(cpus) if cpus.isdigit() else 8, shared)
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(10**6).selectExpr("sum(id)").collect()
    times = {}
    for name in HEADLINE:
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(min(runs), 3)
    total = round(sum(times.values()), 3)
    sf = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "headline query time", "value": total, "unit": "sec", "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
