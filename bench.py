"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]: median of three after a warm-up."""

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from candlewright.plans.queries import QUERIES

HEADLINE = [
    "ohlcv_1h", "ohlcv_rollup", "volume_profile", "moving_averages", "macd", "triggered_rules",
    "rules_apply_log",
]


def seconds(spark, name: str, sf_dir: str) -> float:
    began = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        seconds(spark, name, sf_dir)
        times[name] = round(statistics.median(seconds(spark, name, sf_dir) for _ in range(3)), 3)
    print(json.dumps({
        "metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
