"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` (default sf0.1) and ``BENCH_CPUS`` choose data and cores;
``BENCH_QUERIES`` (comma-separated, or ``all``) chooses queries. After a warm-up each
query's time is the median of ``BENCH_RUNS`` (3) runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from evenkeel.catalogue import QUERIES  # noqa: E402
from evenkeel.session import build_session  # noqa: E402

HEADLINE = (
    "site_daily_signals", "event_timeline", "rolling_context", "reliability_index", "open_orders_by_sweep",
    "conformed_alarms", "conformed_work_orders", "exploded_readings", "latest_item_per_line", "duplicate_items",
    "fused_order_checks", "key_checks", "email_and_null_scan", "creation_features", "intake_features",
    "chronological_split", "classification_metrics", "precision_at_k", "calibration_table", "price_distribution_by_flag",
    "violation_rates_all_dimensions", "column_profile", "dispatch_queue", "task_assignments", "cleaning_priority",
    "maintenance_calendar", "site_reliability", "isolation_forest", "boosted_model_metrics",
    "logistic_predictions", "permutation_importance", "forest_importance", "segment_models",
)
#: A query that takes longer is timed once.
LONG_SECONDS = 12.0


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else [n for n in chosen.split(",") if n] or list(HEADLINE)
    spark = build_session("bench", **{
        "spark.master": f"local[{cpus}]", "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
        "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    runs = int(os.environ.get("BENCH_RUNS", "3"))

    def timed(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    for name in names[:8]:  # start-up and compilation are not a query's time
        timed(name)
    seconds = {}
    for name in names:
        took = [timed(name)]
        while len(took) < runs and took[0] < LONG_SECONDS:
            took.append(timed(name))
        seconds[name] = round(statistics.median(took), 3)
    print(json.dumps({
        "metric": "total query time", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
    }))
    spark.stop()


if __name__ == "__main__":
    main()
