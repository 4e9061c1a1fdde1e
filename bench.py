"""Time the headline queries: one JSON line on standard output."""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from pyspark.sql import SparkSession

from shelfwise.plans import catalog

HEADLINE = (
    "D1_daily_sales", "D2_regular_sales", "D4_monthly_sales", "D6_product_performance", "D11_sales_kpi",
    "D17_daily_state", "B1_clean_sales", "C13_insert_new", "I1_dim_product", "I4_abc_rows", "I6_rfm_customers",
    "I8_flag_outliers", "H6_seasonal_factors", "J1_inventory_policy", "J10_purchase_order", "E10_rolling",
    "M1_training_history", "M18_accuracy", "H7_with_seasonal", "I15_enrich_stats",
)
#: Timed runs of each query, of which the median counts.
RUNS = 3


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    runs = catalog.queries()

    def run(name: str) -> float:
        start = time.perf_counter()
        runs[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in HEADLINE:
        run(name)  # untimed: compiles the query's code
        seconds[name] = round(statistics.median(run(name) for _ in range(RUNS)), 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
