"""Benchmark the headline queries; prints ONE JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_REPEAT (default 2; best of N runs per query, after the warm-up),
     BENCH_WARMUP_DIR (default /root/testdata/sf0.001; "" to skip).
Like the reference's timing scripts, every code path is warmed up first (untimed,
on the smallest scale, other files), so the numbers are steady-state JVM times.
Each query runs to completion through the ``noop`` sink (no collect).
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "daily_rollup", "daily_rollup_events", "monthly_rollup", "yearly_rollup", "rollup_join_form",
    "station_cells", "location_dim", "hourly_fact",
    "snapshot_hourly", "snapshot_daily", "snapshot_monthly", "snapshot_yearly",
    "series_hourly", "series_daily", "series_monthly", "series_yearly",
    "range_cross_year", "query_dispatch", "full_build_monthly",
]


def _timed(f) -> float:
    t = time.time()
    f()
    return round(time.time() - t, 3)


def layout_compare(spark, sf_dir: str) -> dict[str, float]:
    from meteocube.operators.hourly import hourly_fact
    from meteocube.plans import catalog
    from meteocube.plans.build import build, hourly_order, hourly_spread
    from meteocube.plans.queries import series, snapshot
    from meteocube.session import scratch_path
    from meteocube.sinks.parquet import write_table
    from meteocube.sources import testtables as tt
    from meteocube.sources.raw import read_csv

    out: dict[str, float] = {}
    obs = catalog.all_observations(spark, sf_dir)
    pq_path, csv_path = scratch_path(spark, "bench-raw-pq"), scratch_path(spark, "bench-raw-csv")
    obs.write.parquet(pq_path)
    obs.write.option("header", True).csv(csv_path)
    out["hourly_from_parquet"] = _timed(lambda: write_table(
        hourly_fact(spark.read.parquet(pq_path)), scratch_path(spark, "h"), ("year", "month"), "clustered", hourly_order(), hourly_spread()))
    out["hourly_from_csv"] = _timed(lambda: write_table(
        hourly_fact(read_csv(spark, csv_path)), scratch_path(spark, "h"), ("year", "month"), "clustered", hourly_order(), hourly_spread()))
    places = tt.nation_gazetteer(spark, sf_dir)
    cubes = {"clustered": catalog.cube(spark, sf_dir)}
    out["build_small_files"] = _timed(lambda: cubes.__setitem__(
        "small_files", build(spark, spark.read.parquet(pq_path), places, scratch_path(spark, "cube-small"), "small_files")))
    for layout, c in cubes.items():
        for level, metric, agg, (s, e) in catalog.SNAPSHOTS.values():
            out[f"snapshot_{level}_{layout}"] = _timed(lambda: snapshot(
                c.table(level), c.locations(), level, metric, agg, s, e).write.format("noop").mode("overwrite").save())
        for level, metric, agg, (s, e) in catalog.SERIES.values():
            out[f"series_{level}_{layout}"] = _timed(lambda: series(
                c.table(level), level, metric, agg, s, e, catalog.STATION).write.format("noop").mode("overwrite").save())
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    from pyspark.sql import SparkSession

    from meteocube.plans import catalog
    from meteocube.plans.build import build
    from meteocube.session import scratch_path
    from meteocube.sources import testtables as tt

    shared = tempfile.mkdtemp(prefix="meteocube-bench-")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("meteocube-bench")
             .config("spark.checkpoint.dir", f"file://{shared}")
             .config("spark.sql.shuffle.partitions", str(max(8, 2 * cpus)))
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "16g"))
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    qs = catalog.spark_queries()
    warm = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001").rstrip("/")
    if warm and warm != sf_dir and os.path.isdir(warm):
        catalog.cube(spark, warm)
        for name in HEADLINE:
            qs[name](spark, warm).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    builds = [_timed(lambda: catalog.cube(spark, sf_dir))]   # the cube every query below reads
    for _ in range(repeat - 1):                               # further builds to fresh paths, timing only
        builds.append(_timed(lambda: build(spark, catalog.all_observations(spark, sf_dir),
                                           tt.nation_gazetteer(spark, sf_dir), scratch_path(spark, "bench-cube"))))
    times["cube_build"] = min(builds)
    for name in HEADLINE:
        best = None
        for _ in range(repeat):
            t = time.time()
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt_ = time.time() - t
            best = dt_ if best is None else min(best, dt_)
        times[name] = round(best, 3)
    compare = {} if os.environ.get("BENCH_SKIP_COMPARE") else layout_compare(spark, sf_dir)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else None, "compare": compare}))
    spark.stop()


if __name__ == "__main__":
    main()
