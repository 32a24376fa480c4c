"""Wall time of the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables and ``BENCH_CPUS`` the number of local threads.  Each query
is run once, over whole tables, after one warm-up query.  Progress goes to stderr; a query that fails or
passes its limit is named in ``failed``.
"""

from __future__ import annotations

import json
import os
import sys
import threading
import time
from collections.abc import Callable

from pyspark.sql import SparkSession

from saleslane.plans.queries import queries

HEADLINE = (
    "load_sku_day",
    "interpolate_low_instock",
    "interpolate_long_gaps",
    "category_rollup",
    "panel_with_exog",
    "validate_panel",
    "holiday_flag",
    "engineer_features",
    "weather_quantiles",
    "expanding_folds",
    "ets_fit",
    "ets_search",
    "ets_components",
    "ets_forecast",
    "climatology",
    "future_frame",
    "metrics_by_category",
    "metrics_with_total",
    "component_metrics",
    "residual_histogram",
    "run_summary",
    "residual_model_mae",
    "tuning_trials",
    "pipeline_forecast",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = queries()
    registered["category_rollup"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    seconds, failed = {}, {}
    try:
        for name in HEADLINE:
            took = timed(spark, lambda: registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save())
            if isinstance(took, float):
                seconds[name] = took
            else:
                failed[name] = took
            print(name, took, file=sys.stderr, flush=True)
    except KeyboardInterrupt:
        failed["stopped_at"] = name
    report = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")),
    }
    if failed:
        report["failed"] = failed
    print(json.dumps(report), flush=True)
    spark.stop()


def timed(spark: SparkSession, action: Callable[[], None]) -> float | str:
    """Seconds that an action takes, or why it has none; its jobs are ended at the limit."""
    limit = float(os.environ.get("BENCH_QUERY_SECONDS", "300"))
    timer = threading.Timer(limit, spark.sparkContext.cancelAllJobs)
    start = time.perf_counter()
    timer.start()
    try:
        action()
    except Exception as error:  # one failing query leaves the figures of the others
        late = time.perf_counter() - start >= limit
        return f"over {limit:g} s" if late else f"{type(error).__name__}: {error}"[:300]
    finally:
        timer.cancel()
    return round(time.perf_counter() - start, 3)


if __name__ == "__main__":
    main()
