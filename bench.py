"""Times the headline queries and prints one JSON line.

Each query runs once to warm up and then BENCH_RUNS times (default 3); the median counts.
Results are computed in full and thrown away. The feed is landed and the tables that
queries read are saved beforehand, outside the times.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession

from pulsemart import testdata
from pulsemart.checks.queries import QUERIES
from pulsemart.operators import metrics, quality, star
from pulsemart.plans import batch, dashboard
from pulsemart.session import configure, scratch_table
from pulsemart.sinks.tables import refresh

HEADLINE = [
    "sales_vs_goal",
    "monthly_orders",
    "quantity_by_rep_state",
    "distinct_topics",
    "distinct_topics_inferred",
    "distinct_topics_table",
    # The rest of the dashboard and the questions.
    "revenue_share_by_state",
    "avg_amount_by_product",
    "dashboard_unfiltered",
    "dashboard_filtered",
    "monthly_orders_saved",
    "dashboard_saved",
    "order_history",
    "browse_orders",
    "key_check",
    "revenue_by_rep_in_state",
    "top_rep_in_state",
    # The message feed.
    "bpm_silver",
    "find_duplicates",
    "quality_report",
    "avg_bpm_batch",
    "next_batch",
    "landing_replay",
    "stream_silver",
    "avg_bpm_stream",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = configure(
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    raw = testdata.landed(spark, sf_dir)
    bronze = batch.bronze(spark, raw, scratch_table(spark, "bronze"))
    history = refresh(
        spark,
        scratch_table(spark, "orderhistory"),
        lambda: star.order_history(
            testdata.orders(spark, sf_dir),
            testdata.customers(spark, sf_dir),
            testdata.products(spark, sf_dir),
        ),
    )
    extra = {
        "distinct_topics_inferred": lambda s, d: quality.distinct_topics(s.read.json(raw)),
        "distinct_topics_table": lambda s, d: quality.distinct_topics(bronze),
        "monthly_orders_saved": lambda s, d: metrics.monthly_orders(history, testdata.DECIMALS),
        "dashboard_saved": lambda s, d: dashboard.page_in_one_pass(
            history, decimals=testdata.DECIMALS
        ),
    }

    def timed(name: str) -> float:
        run = extra.get(name) or QUERIES[name]
        begin = time.perf_counter()
        result: DataFrame = run(spark, sf_dir)
        result.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begin

    chosen = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    times: dict[str, float] = {}
    for name in chosen:
        timed(name)
        times[name] = round(statistics.median(timed(name) for _ in range(runs)), 4)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 4),
                "unit": "sec",
                "queries": times,
                "sf": sf_dir.rsplit("sf", 1)[-1],
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
