"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from panelforge.workload.catalog import REGISTRY

HEADLINE = (
    "build_monthly_panel build_daily_panel accounting_panel size_concentration size_summary industry_stats book_equity_coverage "
    "beta_monthly beta_daily beta_trailing_days beta_table beta_deciles median_sort decile_sort capm_performance size_premium "
    "specification_grid sorting_panel double_sort_independent double_sort_dependent bond_universe bonds_outstanding "
    "clean_trades trade_day_summary month_end_returns efficient_frontier winsorize panel_regressions ols_fe_twoway se_newey_west"
).split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "1"))
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("panelforge-bench")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", os.environ.get("BENCH_SHARED_DIR") or tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    REGISTRY["size_concentration"].run(spark, sf_dir).count()
    seconds = {}
    for name in names:
        runs = []
        for _ in range(repeats):
            begin = time.perf_counter()
            REGISTRY[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - begin)
        seconds[name] = round(statistics.median(runs), 3)
    line = {"metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": sf_dir.rsplit("sf", 1)[-1]}
    print(json.dumps(line))


if __name__ == "__main__":
    main()
