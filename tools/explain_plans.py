"""Write PLANS.md: physical plans of the key operators at sf0.01 (simple explain mode).

usage: python tools/explain_plans.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def plan(df, mode="simple") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    text = re.sub(r"#\d+L?", "", buf.getvalue())           # drop expression ids
    text = re.sub(r"\[plan_id=\d+\]", "", text)
    text = re.sub(r"file:/[^\s,\]]+", "<path>", text)
    return text.strip()


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    from meteocube.operators.hourly import hourly_fact
    from meteocube.functions.geo import grid_col, grid_row
    from meteocube.operators.locations import _level
    from meteocube.plans import catalog
    from meteocube.plans.build import hourly_order
    from meteocube.sinks.parquet import _clustered
    from meteocube.sources import testtables as tt

    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    q = catalog.spark_queries()
    c = catalog.cube(spark, sf)
    raw = catalog.all_observations(spark, sf)
    pts = c.locations().select("id", "LATITUDE", "LONGITUDE")
    pl = F.broadcast(tt.nation_gazetteer(spark, sf)).select(
        "place_key", "name", "cc", F.col("lat").alias("_plat"), F.col("lon").alias("_plon"))
    level = _level(pts, pl, ["id", "LATITUDE", "LONGITUDE"], "LATITUDE", "LONGITUDE", 90.0, packed=True)
    base = 360.0 / 64
    occupied = F.broadcast(pl.groupBy(grid_row(F.col("_plat"), base).alias("bgr"), grid_col(F.col("_plon"), base).alias("bgc"))
                           .agg(F.min_by("_plat", "place_key").alias("_rlat"), F.min_by("_plon", "place_key").alias("_rlon")))
    coarse = _level(pts, pl, ["id", "LATITUDE", "LONGITUDE"], "LATITUDE", "LONGITUDE", 90.0, True, base, occupied)
    sections = [
        ("Build: hourly fact write (REBALANCE on year, month; sort by day, id, time)",
         _clustered(hourly_fact(raw), ("year", "month"), hourly_order())),
        ("A1 daily rollup (one aggregate, partial before the exchange)", q["daily_rollup"](spark, sf)),
        ("A2 monthly rollup from daily (two levels, two exchanges, both pre-aggregated)", q["monthly_rollup"](spark, sf)),
        ("J1 reference join form (for comparison)", q["rollup_join_form"](spark, sf)),
        ("J3 one level of the nearest-place join (grid equi-join, broadcast gazetteer, packed arg-min)", level),
        ("J3 a coarse level: occupied base cells first, pruned by distance bounds, then their places", coarse),
        ("Q2 snapshot daily over the stored cube", q["snapshot_daily"](spark, sf)),
        ("Q5 series hourly over the stored cube", q["series_hourly"](spark, sf)),
        ("Q3 snapshot monthly over the stored cube", q["snapshot_monthly"](spark, sf)),
    ]
    out = ["# PLANS", "", f"Physical plans (Spark {spark.version}, `explain()`), generated by `tools/explain_plans.py` "
           f"at `{sf}`. Expression ids and paths removed.", ""]
    for title, df in sections:
        out += [f"## {title}", "", "```", plan(df), "```", ""]
    scan = plan(q["series_daily"](spark, sf), "formatted")
    keep = [ln for ln in scan.splitlines() if re.search(r"Scan parquet|PartitionFilters|PushedFilters|ReadSchema", ln)]
    out += ["## Q6 series daily: scan details", "", "```", *keep, "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))


if __name__ == "__main__":
    main()
