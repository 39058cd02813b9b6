"""Plan-shape rules for every registered query (run at the smallest scale)."""

import re
import types

import pytest

from meteocube.plans import catalog

from helpers import plan_text

E = types.SimpleNamespace(queries=catalog.spark_queries)

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_no_cross_join_and_no_python_in_plan(spark, name):
    df = E.queries()[name](spark, "/root/testdata/sf0.001")
    plan = plan_text(df, "extended")
    bad = [f for f in FORBIDDEN if f in plan]
    assert not bad, f"{name}: {bad}"

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["snapshot_hourly", "snapshot_daily", "snapshot_monthly", "snapshot_yearly",
                                  "range_cross_year"])
def test_snapshots_broadcast_the_checked_dimension_and_prune(spark, name):
    plan = plan_text(E.queries()[name](spark, SF), "formatted")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    if name != "snapshot_yearly":
        filters = re.search(r"PartitionFilters: \[(.*)\]", plan).group(1)  # the conjuncts come in any order
        assert "year" in filters and ">=" in filters and "<=" in filters, filters


@pytest.mark.parametrize("name", ["series_hourly", "series_daily", "series_monthly", "series_yearly"])
def test_series_push_the_station_to_the_scan(spark, name):
    plan = plan_text(E.queries()[name](spark, SF), "formatted")
    assert "EqualTo(id,1700-1237)" in plan


@pytest.mark.parametrize("name,exchanges", [("daily_rollup", 1), ("monthly_rollup", 2), ("yearly_rollup", 2)])
def test_rollups_one_preaggregated_exchange_per_level(spark, name, exchanges):
    plan = plan_text(E.queries()[name](spark, SF), "simple")
    assert plan.count("Exchange hashpartitioning") == exchanges
    assert plan.count("partial_sum") >= 4 * exchanges
    assert "SortAggregate" not in plan and "Join" not in plan.replace("BroadcastHashJoin", "")


def test_nearest_place_descends_with_broadcast_cells(spark):
    from meteocube.operators.locations import candidates

    pts = spark.createDataFrame([("a", 10.0, 10.0)], "id string, LATITUDE double, LONGITUDE double")
    pl = spark.createDataFrame([(1, "X", "YY", 11.0, 11.0), (2, "Z", "YY", -30.0, 40.0)],
                               "place_key long, name string, cc string, lat double, lon double")
    df, _ = candidates(pts, pl, base_cell_deg=360.0 / 64)
    plan = plan_text(df, "simple")
    assert plan.count("BroadcastHashJoin") == 5 and "SortMergeJoin" not in plan  # k = 1, 2, 4, 6 and the places
    assert plan.count("Exchange hashpartitioning(id") == 1  # every level's bound reuses one partitioning by point
    assert [(r.id, r.place_key) for r in df.collect()] == [("a", 1)]


def test_clustered_write_plan_rebalances_and_sorts(spark):
    from pyspark.sql import functions as F

    from meteocube.plans.build import hourly_order
    from meteocube.sinks.parquet import _clustered

    df = spark.range(10).select(F.col("id").cast("string").alias("id"),
                                F.timestamp_seconds(F.col("id") * 3600).cast("timestamp_ntz").alias("DATE"),
                                (F.col("id") % 3).cast("int").alias("year"), (F.col("id") % 12).cast("int").alias("month"))
    plan = plan_text(_clustered(df, ("year", "month"), hourly_order()), "simple")
    assert "REBALANCE_PARTITIONS_BY_COL" in plan and "Sort [year" in plan


#: HotSpot interprets methods above this many bytes of code.
HUGE_METHOD = 8000


@pytest.mark.parametrize("name", ["daily_rollup", "rollup_join_form", "monthly_rollup", "yearly_rollup", "daily_rollup_fine",
                                  "daily_rollup_large", "daily_rollup_events", "hourly_fact"])
def test_generated_methods_are_small_enough_to_compile(spark, name):
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the whole plan at once
    try:
        plan = E.queries()[name](spark, SF)._jdf.queryExecution().executedPlan()
        debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
        code = debug.codegenStringSeq(plan)
        sizes = [code.apply(i)._3().maxMethodCodeSize() for i in range(code.size())]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert sizes and max(sizes) < HUGE_METHOD, sizes


def test_sort_keys_are_computed_once_per_row(spark):
    from pyspark.sql import functions as F

    from meteocube.plans.build import hourly_order, hourly_spread
    from meteocube.sinks.parquet import _clustered

    df = spark.range(10).select(F.col("id").cast("string").alias("id"), F.timestamp_seconds(F.col("id") * 3600).alias("DATE"),
                                F.lit(1970).alias("year"), F.lit(1).alias("month"))
    out = _clustered(df, ("year", "month"), hourly_order(), hourly_spread())
    sort = next(line for line in plan_text(out, "simple").splitlines() if " Sort [" in line)
    assert "cast(" not in sort and sort.index("_order_0") < sort.index("id#") and out.columns == df.columns
