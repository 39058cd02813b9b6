"""Range queries over the stored cube tables.

Two kinds of answer at four levels:

* snapshot -- every station in the range, LEFT JOINed to its place and
  coordinates (one dimension row per id, so the join never multiplies rows);
* series -- one station's values over the range.

Predicates are built with the Column API from checked arguments (no SQL text
is assembled from request values).  Each range predicate carries a
year/month conjunct, so partitioned tables prune directories, and the exact
time bound plus the station equality reach the parquet reader as pushed
filters.  Results are always ordered by time (then id).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import day_range, hour_range, month_range, period_label, year_month_code, year_range
from ..operators.joins import join_small
from ..schema import ALLOWED_AGGS, LEVELS, METRICS


#: Columns that order an answer in time, by level.
TIME_COLUMNS = {"hourly": ("DATE",), "daily": ("DATE",), "monthly": ("year_month",), "yearly": ("year",)}


def value_column(level: str, agg: str, metric: str) -> str:
    """The measure column a request names, checked against the fixed sets.

    Hourly values are raw readings: the aggregation of a request is ignored there.
    """
    if level not in LEVELS:
        raise ValueError(f"level must be one of {LEVELS}, got {level!r}")
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}, got {metric!r}")
    agg = agg or ""
    if level == "hourly":
        return metric
    if agg not in ALLOWED_AGGS[level]:
        raise ValueError(f"agg {agg!r} not allowed at level {level!r}; allowed: {ALLOWED_AGGS[level]}")
    return f"{agg}{metric}"


def _facts(table: DataFrame, level: str, col: str, start, end) -> DataFrame:
    """Range-filtered facts with the time columns of the level."""
    if level == "hourly":
        return table.filter(hour_range(start, end)).select("DATE", "id", F.round(col, 2).alias(col))
    if level == "daily":
        return table.filter(day_range(start, end)).select("DATE", "id", col)
    if level == "monthly":
        return table.filter(month_range(start, end)).select(
            year_month_code().alias("year_month"), period_label().alias("label"), "id", col)
    return table.filter(year_range(start, end)).select("year", "id", col)


def snapshot(table: DataFrame, locations: DataFrame, level: str, metric: str, agg: str,
             start, end, ordered: bool = True, location_rows: int | None = None) -> DataFrame:
    """Q1-Q4: all stations in [start, end] with city and coordinates.

    ``ordered=False`` leaves out the final sort (for counting or aggregating the
    answer: a limit over a sorted plan would become a top-k).  ``location_rows``
    is a measured row count of ``locations`` (skips the broadcast check's count).
    """
    col = value_column(level, agg, metric)
    facts = _facts(table, level, col, start, end)
    dim = locations.select("id", "city", "LATITUDE", "LONGITUDE")
    out = join_small(facts, dim, "id", "left", small_rows=location_rows).select(
        *facts.columns, "city", "LATITUDE", "LONGITUDE")
    return out.orderBy(*TIME_COLUMNS[level], "id") if ordered else out


def series(table: DataFrame, level: str, metric: str, agg: str, start, end, station: str,
           ordered: bool = True) -> DataFrame:
    """Q5-Q8: one station's values over [start, end]."""
    col = value_column(level, agg, metric)
    if not station:
        raise ValueError("series needs a station id")
    facts = _facts(table.filter(F.col("id") == F.lit(station)), level, col, start, end)
    out = facts.drop("id")
    return out.orderBy(*TIME_COLUMNS[level]) if ordered else out


def station_listing(points: DataFrame) -> DataFrame:
    """Q9: the station list, every distinct coordinate with its city and id, ordered by id."""
    return points.select("city", "id", "LATITUDE", "LONGITUDE").orderBy("id", "LATITUDE", "LONGITUDE")
