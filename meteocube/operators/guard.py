"""Result guard, value range and preview."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..schema import ROW_LIMIT

NO_DATA = "No Data"
TOO_LARGE = "Too Large"
OK = "ok"


def status_of(rows: int, cap: int | None = ROW_LIMIT) -> str:
    """O4: 'No Data' for an empty answer, 'Too Large' beyond ``cap`` rows (None: never), else 'ok'."""
    return NO_DATA if rows == 0 else TOO_LARGE if cap is not None and rows > cap else OK


def check_result(df: DataFrame, cap: int | None = ROW_LIMIT) -> str:
    """The status of an answer, from its true row count (a distributed count)."""
    return status_of(df.count(), cap)


def guard_status(df: DataFrame, cap: int | None = ROW_LIMIT) -> DataFrame:
    """O4 as a one-row DataFrame (n_rows: the true count, status), evaluated by Spark."""
    n = F.col("n_rows")
    too_large = F.lit(False) if cap is None else n > cap
    status = F.when(n == 0, F.lit(NO_DATA)).when(too_large, F.lit(TOO_LARGE)).otherwise(F.lit(OK))
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select("n_rows", status.alias("status"))


def value_range(df: DataFrame, column: str) -> DataFrame:
    """(min, max) of a result column, the colour range of a figure."""
    return df.agg(F.min(column).alias("range_min"), F.max(column).alias("range_max"))


def preview(df: DataFrame, order: list[str | Column], n: int = 5) -> DataFrame:
    """O3: first ``n`` rows in a stated order (a top-n, so the answer is deterministic)."""
    return df.orderBy(*order).limit(n)


def fetch(df: DataFrame, order: list[str], cap: int = ROW_LIMIT):
    """(status, pandas frame or None) of an unsorted answer, evaluated once.

    At most ``cap`` + 1 rows reach the driver; one row too many is the sign of a too large answer. Within
    the cap the frame is sorted here, by ``order``.
    """
    frame = df.limit(cap + 1).toPandas()
    status = status_of(len(frame), cap)
    return status, (frame.sort_values(order, kind="stable", ignore_index=True) if status == OK else None)


def numbered(df: DataFrame, first: str, then: str, name: str = "place") -> DataFrame:
    """``df`` with its rows' places (from 1) in the order of two columns, without one task for all rows.

    Rows are numbered inside each value of ``first`` (a period: as many rows as stations), and moved on by the rows of
    the periods before, of which one small table with a row per period is summed.
    """
    sizes = df.groupBy(first).agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select(F.col(first).alias("_first"), (F.sum("_n").over(W.orderBy(first)) - F.col("_n")).alias("_before"))
    inside = df.withColumn("_at", F.row_number().over(W.partitionBy(first).orderBy(then)))
    place = (F.col("_before") + F.col("_at")).cast("int").alias(name)
    return inside.join(F.broadcast(before), F.col(first).eqNullSafe(F.col("_first"))).select(place, *df.columns)
