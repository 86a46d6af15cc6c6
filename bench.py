"""Times every query; prints one JSON line.

Environment: BENCH_SF_DIR (data folder), BENCH_CPUS (local threads). The tables
that queries share are written first and timed as ``build_*``; then each query
runs once into the noop sink, so that every output row is computed.
"""

import contextlib
import json
import os
import sys
import time

from pyspark.sql import SparkSession

from uptake.catalog import QUERIES, workspace

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = (
    "mart_customer_sku_month",
    "mart_customer_feature_month",
    "mart_customer_month",
    "mart_product_month",
    "portfolio_kpis",
    "kpi_movement",
    "top_movers",
    "product_model_table",
    "dq_report",
)


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(action) -> float:
    began = time.perf_counter()
    action()
    return round(time.perf_counter() - began, 3)


def main(names: list[str]) -> None:
    spark = session()
    space = workspace(spark, FOLDER)
    spark.range(1000).write.format("noop").mode("overwrite").save()  # start the executors' threads
    seconds = {
        "build_sources": timed(lambda: space.raw),
        "build_sku_mart": timed(lambda: space.sku),
        "build_full_mart": timed(lambda: space.full),
        "build_feature_mart": timed(lambda: space.feature),
    }
    for name in names or QUERIES:
        query = QUERIES[name]
        seconds[name] = timed(lambda q=query: q(space).write.format("noop").mode("overwrite").save())
    space.close()
    headline = sum(s for name, s in seconds.items() if name in HEADLINE or name.startswith("build_"))
    print(
        json.dumps(
            {
                "metric": "build and headline queries, total",
                "value": round(headline, 3),
                "unit": "sec",
                "queries": seconds,
                "all_queries_total": round(sum(seconds.values()), 3),
                "sf": os.path.basename(FOLDER).removeprefix("sf"),
                "cpus": int(CPUS),
            }
        )
    )


if __name__ == "__main__":
    with contextlib.suppress(KeyboardInterrupt):
        main(sys.argv[1:])
