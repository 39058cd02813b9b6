"""Parquet sinks and physical layout (K1-K6).

Layouts
-------
``clustered`` (default, K3)
    ``REBALANCE`` on the partition columns and ``spread``: rows of one key meet
    in one shuffle partition, and AQE splits any partition above the advisory
    size and merges small ones.  Each directory gets files of bounded size, so
    no task ever holds a whole month at scale.  With ``spread`` = the day, a day's
    rows are in one file of their month (more only where AQE splits a hot day), so
    a snapshot opens the files of its days and not the whole month.  Rows are
    sorted by the partition columns and then ``sort_by`` inside each file, so
    min/max statistics let range and station lookups skip row groups and pages.
``small_files`` (K5)
    No exchange before the write: every input task writes into every
    directory it touches (the small-file control case).
``single_file`` (K4)
    One file, written by one task: for tables that the caller knows to be
    small (stations x years), never chosen by the library itself.

``row_group_bytes`` bounds the row groups of the files it is given for (default: parquet's 128 MB).  Inside an hourly
file a station's rows of a day are one range, so with a day cut into several row groups a series opens the groups
whose id range holds the station and skips the others by their statistics; in ``small_files`` every group holds
about every station.  Where ids of a group repeat, parquet keeps their dictionary, which it reads as an exact filter,
and writes no bloom filter beside it; so there is no switch for one.

All writes are ``overwrite`` to a path of their own; Spark's commit protocol
makes a re-run after a lost executor or a failed attempt idempotent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

LAYOUTS = ("clustered", "small_files", "single_file")


def _clustered(df: DataFrame, partition_by: tuple[str, ...], sort_by: tuple[str | Column, ...],
               spread: dict[str, Column] | None = None) -> DataFrame:
    spread = spread or {}
    out = df.withColumns(spread).hint("rebalance", *partition_by, *spread) if partition_by else df.hint("rebalance")
    # A sort evaluates an expression again in every comparison: a day out of a timestamp costs more than the sort.
    keys = {f"_order_{k}": c for k, c in enumerate(sort_by) if isinstance(c, Column)}
    order = (*partition_by, *(f"_order_{k}" if isinstance(c, Column) else c for k, c in enumerate(sort_by)))
    out = out.withColumns(keys).sortWithinPartitions(*order).drop(*keys) if order else out
    return out.drop(*spread) if partition_by else out


def write_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), layout: str = "clustered",
                sort_by: tuple[str | Column, ...] = (), spread: dict[str, Column] | None = None,
                row_group_bytes: int | None = None) -> str:
    """K1/K2 (+K3/K4/K5 by ``layout``): overwrite ``path`` with ``df`` as parquet."""
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}, got {layout!r}")
    out = df
    if layout == "clustered":
        out = _clustered(df, partition_by, sort_by, spread)
    elif layout == "single_file":
        order = (*partition_by, *sort_by)
        out = df.repartition(1)
        out = out.sortWithinPartitions(*order) if order else out
    writer = out.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if row_group_bytes is not None:
        writer = writer.option("parquet.block.size", str(row_group_bytes))
    writer.parquet(path)
    return path


def write_sorted(df: DataFrame, path: str, order: tuple[str, ...]) -> str:
    """O1 + K1: globally sorted, unpartitioned table (range partitioning, no single task)."""
    df.orderBy(*order).write.mode("overwrite").parquet(path)
    return path


def materialize(spark: SparkSession, df: DataFrame, path: str, partition_by: tuple[str, ...] = (),
                layout: str = "clustered", sort_by: tuple[str | Column, ...] = (),
                spread: dict[str, Column] | None = None, row_group_bytes: int | None = None) -> DataFrame:
    """K6: write, then continue from the written table (cuts lineage, survives restarts).

    The schema is the written one, so a table without rows, which leaves no file, is read back as well.
    """
    write_table(df, path, partition_by, layout, sort_by, spread, row_group_bytes)
    return spark.read.schema(df.schema).parquet(path)
