import datetime as dt

import pytest
from pyspark.sql import functions as F

from meteocube.functions.calendar import day_range, hour_range, month_range, year_range
from meteocube.sinks.parquet import write_table

from helpers import plan_text


@pytest.fixture(scope="module")
def calendar(spark):
    """One row per day 2019-01-01..2023-12-31 with year/month columns."""
    days = spark.sql("SELECT explode(sequence(DATE'2019-01-01', DATE'2023-12-31', INTERVAL 1 DAY)) AS DATE")
    return days.withColumns({"year": F.year("DATE"), "month": F.month("DATE")})


@pytest.mark.parametrize("start,end,n", [
    ("2020-01-15", "2020-02-10", 27),     # adjacent months (D2)
    ("2020-11-15", "2021-02-10", 88),     # cross year (D3)
    ("2020-06-01", "2022-06-30", 760),
    ("2020-02-29", "2020-02-29", 1),      # leap day, start = end
    ("2020-03-05", "2020-03-20", 16),     # same month
    ("2024-01-01", "2024-01-31", 0),      # empty
])
def test_day_range_closed_interval(calendar, start, end, n):
    assert calendar.filter(day_range(start, end)).count() == n


def test_hour_range_includes_whole_end_day(spark):
    ts = [dt.datetime(2022, 12, 29, 23), dt.datetime(2022, 12, 30, 0), dt.datetime(2022, 12, 30, 23, 59),
          dt.datetime(2022, 12, 31, 0)]
    df = spark.createDataFrame([(t,) for t in ts], "DATE timestamp_ntz").withColumns(
        {"year": F.year("DATE"), "month": F.month("DATE")})
    got = [r.DATE for r in df.filter(hour_range("2022-12-30", "2022-12-30")).collect()]
    assert got == ts[1:3]


def test_month_and_year_ranges_ignore_days(calendar):
    assert calendar.filter(month_range("2020-11-30", "2021-01-01")).count() == 30 + 31 + 31
    assert calendar.filter(year_range("2020-12-31", "2021-01-01")).count() == 366 + 365


def test_range_prunes_partitions_and_pushes_date(spark, calendar, tmp_dir):
    path = f"{tmp_dir}/cal"
    write_table(calendar.withColumn("v", F.lit(1.0)), path, ("year", "month"), "clustered", ("DATE",))
    plan = plan_text(spark.read.parquet(path).filter(day_range("2020-01-15", "2020-02-10")))
    part = [line for line in plan.splitlines() if "PartitionFilters" in line]
    pushed = [line for line in plan.splitlines() if "PushedFilters" in line]
    assert part and "year" in part[0] and "month" in part[0]
    assert pushed and "DATE" in pushed[0] and "GreaterThanOrEqual" in pushed[0]
    assert spark.read.parquet(path).filter(day_range("2020-01-15", "2020-02-10")).count() == 27


def test_hour_range_ignores_session_time_zone(spark):
    ts = [dt.datetime(2022, 12, 29, 23), dt.datetime(2022, 12, 30, 0), dt.datetime(2022, 12, 31, 0)]
    df = spark.createDataFrame([(t,) for t in ts], "DATE timestamp_ntz").withColumns(
        {"year": F.year("DATE"), "month": F.month("DATE")})
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("UTC", "America/Los_Angeles", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            assert [r.DATE for r in df.filter(hour_range("2022-12-30", "2022-12-30")).collect()] == ts[1:2]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
