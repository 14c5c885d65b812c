"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the local cores, BENCH_QUERIES an
optional comma-separated choice. Every query runs its whole plan into a sink that
keeps nothing. ``staged_layer`` is the one-off build the marts and reports share,
``raw_layer`` the one the quality runs share. ``colocated_stg_payment_attempts`` and
``incremental_revenue`` are charged with the whole layout and the three loads they share
with other queries.
"""

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from cohortlake.plans.registry import QUERIES, raw_layer, staged  # noqa: E402

HEADLINE = [
    "stg_users", "stg_enrollments", "stg_payments", "stg_payment_attempts", "stg_ad_costs",
    "mart_revenue", "mart_ad_performance", "mart_activity", "mart_completion", "mart_conversion",
    "dq_raw", "dq_staging", "dq_compare", "dq_extra_rules",
    "report_active_users", "report_top_products", "report_revenue_structure",
    "report_weekly_channels", "report_operations", "export_at_risk_students",
    "unconfirmed_attempts", "course_history", "payments_at_list_price", "net_revenue",
    "attempts_renumbered", "incremental_daily_orders",
    "colocated_stg_payment_attempts", "merged_course_history", "staging_reasons",
    "active_users_rollup", "unconfirmed_attempts_stream", "dq_stream_totals",
    "report_last_six_months", "layer_row_counts", "incremental_revenue",
]


def _timed(run) -> float:
    start = time.perf_counter()
    run()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    chosen = os.environ.get("BENCH_QUERIES")
    scratch = tempfile.mkdtemp(prefix="cohortlake-bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", f"{scratch}/shared")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/region.parquet").count()  # starts the executors
    times = {
        "staged_layer": _timed(lambda: staged(spark, sf_dir).all()),
        "raw_layer": _timed(lambda: raw_layer(spark, sf_dir).all()),
    }
    for name in chosen.split(",") if chosen else HEADLINE:
        query = QUERIES[name]
        times[name] = _timed(
            lambda q=query: q(spark, sf_dir).write.format("noop").mode("overwrite").save()
        )
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
