"""Size-checked broadcast joins.

A side is broadcast only after its row count has been measured and found
under the bound; beyond it the join stays a shuffle (sort-merge) join, and
AQE can still demote or split it at run time.  Counting a stored table or a
small dimension is a cheap job that reads no measure columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Upper bound on rows of a broadcast side.  ~2M rows of a narrow dimension is
# well under the default 8 GB broadcast limit and executor memory.
MAX_BROADCAST_ROWS = 2_000_000


def bounded_rows(df: DataFrame, limit: int = MAX_BROADCAST_ROWS) -> int:
    """Row count of ``df``, reported up to ``limit + 1``.

    A plain distributed count (partial counts per task, one row per task to the
    final sum).  ``limit(n).count()`` would instead funnel up to n rows of every
    partition through one task.
    """
    return min(df.count(), limit + 1)


def maybe_broadcast(df: DataFrame, limit: int = MAX_BROADCAST_ROWS, rows: int | None = None) -> DataFrame:
    """``F.broadcast(df)`` when it is proven to have at most ``limit`` rows.

    ``rows`` is an already measured (bounded) count of ``df``, if the caller has one.
    """
    n = bounded_rows(df, limit) if rows is None else rows
    return F.broadcast(df) if n <= limit else df


def join_small(big: DataFrame, small: DataFrame, on: str | list[str] | Column, how: str = "inner",
               limit: int = MAX_BROADCAST_ROWS, small_rows: int | None = None) -> DataFrame:
    """Join ``big`` with ``small``, broadcasting ``small`` only under the bound."""
    return big.join(maybe_broadcast(small, limit, small_rows), on, how)
