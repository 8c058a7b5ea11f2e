"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from marketloom import catalog  # noqa: E402
from marketloom.operators import calendar  # noqa: E402
from marketloom.sources import sample  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))

HEADLINE = [
    "raw_struct_records",
    "raw_array_records",
    "clean_prices",
    "asset_calendar_fill_wide",
    "asof_fx",
    "fact_asset_daily",
    "fact_asset_daily_wide",
    "portfolio_summary",
    "portfolio_daily_wide",
    "portfolio_summary_wide",
    "return_matrix",
    "annual_covariance",
    "score_candidates",
    "best_portfolio",
    "optimizer_summary",
    "optimizer_certificate_60",
    "validate_struct_records",
    "validate_array_records",
    "validation_report",
]


def wide_fact_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of the wide asset fact."""
    return catalog._wide_fact(spark, sf_dir)


def wide_fill_expanded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar.fill_prices(
        sample.customer_prices(spark, sf_dir), catalog._dates(spark, sf_dir)
    )


def wide_fill_windowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows by join and window, for comparison; not part of the total."""
    return calendar.fill_prices_windowed(
        sample.customer_prices(spark, sf_dir), catalog._dates(spark, sf_dir)
    )


def seconds(spark: SparkSession, build, sf_dir: str) -> float:
    start = time.perf_counter()
    build(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("marketloom-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(2 * int(CPUS)))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    builds = {name: catalog.QUERIES[name] for name in HEADLINE}
    builds["wide_fact_rows"] = wide_fact_rows
    builds["wide_fill_expanded"] = wide_fill_expanded
    times = {}
    for name, build in builds.items():
        seconds(spark, build, SF_DIR)
        times[name] = round(
            statistics.median(seconds(spark, build, SF_DIR) for _ in range(RUNS)), 3
        )
    total = round(sum(times.values()), 3)
    seconds(spark, wide_fill_windowed, SF_DIR)
    compared = {"wide_fill_windowed": round(seconds(spark, wide_fill_windowed, SF_DIR), 3)}
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": total,
                "unit": "sec",
                "queries": times,
                "compared": compared,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
