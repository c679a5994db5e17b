"""Time the headline queries and print one JSON line.

Each query runs once to warm up and then up to BENCH_RUNS times, fewer if it is slow; the
median counts. Results are computed in full and thrown away by the executors, so nothing but
the query is timed. The training run and the report job are timed once, without a warm-up.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from tiffin.catalog import QUERIES  # noqa: E402
from tiffin.catalog import models  # noqa: E402
from tiffin.plans import training  # noqa: E402
from tiffin.catalog.aggregates import TIE_BREAK  # noqa: E402
from tiffin.jobs import eda_report  # noqa: E402
from tiffin.session import prepare, work_path  # noqa: E402
from tiffin.sources import fixtures  # noqa: E402

HEADLINE = [
    # scan, clean, derive
    "csv_scan_infer", "money_clean", "discount_value_token", "derive_columns",
    # analysis
    "value_counts", "group_mean_profit", "profit_summary", "correlation_matrix", "box_report",
    "box_by_top_restaurant", "box_by_hour", "top_profit_orders", "top_restaurants", "rmse",
    # messages and matching
    "json_decode_requests", "response_kv_encode", "search_bulk_ndjson", "document_schema_cast",
    "attach_context_left", "response_lookup", "pending_requests", "response_within_timeout",
    # model and streams
    "string_index", "score_batch", "dedup_uuid", "dedup_uuid_bounded",
    "late_rows", "await_responses", "foreach_batch_score",
]


SLOW = 3.0


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    wanted = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)

    seconds: dict[str, float] = {}
    quality: dict[str, float] = {}
    if not os.environ.get("BENCH_QUERIES"):
        # The full-size training run; the queries below that need a model train a smaller one
        # during their warm-up.
        rows = models.training_rows(spark, sf_dir, heavy=True)
        start = time.perf_counter()
        result = training.train(rows, models.KEYS, max_depth=5, max_iter=40)
        seconds["gbt_train_depth5_iter40"] = time.perf_counter() - start
        quality = {"rmse": round(result.rmse, 3), "baseline_rmse": round(result.baseline_rmse, 3)}
        models._models[(spark.sparkContext.applicationId, sf_dir)] = result

        orders = fixtures.delivery_orders(spark, sf_dir)
        seconds["eda_report_job"] = timed(
            lambda: eda_report.run(orders, work_path(spark, "report"), TIE_BREAK)
        )

    for name in wanted:
        def run(query=QUERIES[name]) -> None:
            query(spark, sf_dir).write.format("noop").mode("overwrite").save()

        run()
        times = [timed(run)]
        while len(times) < runs and times[0] < SLOW:
            times.append(timed(run))
        seconds[name] = statistics.median(times)
        print(f"{name}: {seconds[name]:.2f}s", file=sys.stderr, flush=True)

    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": {name: round(s, 3) for name, s in seconds.items()},
                "model": quality,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
