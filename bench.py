"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Each query runs once to warm up
and then ``BENCH_RUNS`` times, writing all rows to Spark's ``noop`` sink; the best run counts.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from loamline.demo import catalog
from loamline.demo.tables import Tables
from loamline.session import DEFAULTS

HEADLINES = (
    "bronze_soil",
    "silver_soil",
    "silver_weather",
    "gold_daily",
    "gold_hourly",
    "irrigation_status_latest",
    "moisture_trend_driest5",
    "rain_response",
    "quality_report",
    "measure_profile",
    "reading_gaps",
    "texture_consistency",
    "insert_if_absent",
    "replay_difference",
    "json_pages",
    "stream_dedup",
)


def best(make, runs: int) -> float:
    times = []
    for _ in range(runs + 1):
        start = time.perf_counter()
        make().write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - start)
    return round(min(times[1:] or times), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("loamline bench")
    settings = {
        **DEFAULTS,
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "12g",
        "spark.ui.enabled": "false",
        "spark.log.level": "ERROR",
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()

    queries = catalog.queries()
    seconds = {
        name: best(lambda name=name: queries[name](spark, sf_dir), runs) for name in HEADLINES
    }
    tables = Tables(spark, sf_dir)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "rows": tables.read("events").count(),
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
