"""Daily, monthly and yearly rollups (A1-A3) and the per-metric join form.

Each level is ONE ``groupBy().agg()``: one scan, one exchange, and partial
aggregation before the shuffle, so a station (or a day) that holds a large
share of the rows costs one partial row per map task, not its raw rows.
Means are exact and rounded once, at the end (see ``functions.exact``), so
they do not depend on the partitioning.

Re-aggregation rule: monthly and yearly both read the DAILY table.
``avg`` is the mean of the (rounded) daily means, so every day weighs the
same; ``avg_min``/``avg_max`` are means of the daily extremes; ``min``/``max``
are the extremes of the daily extremes.  Every level is rounded to two places
before the next level reads it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exact import buffers, finite, mean, merged, parts, rounded
from ..schema import METRICS

DAILY_KEYS = ("id", "DATE", "year", "month")
MONTHLY_KEYS = ("id", "year", "month")
YEARLY_KEYS = ("id", "year")


def _with_parts(df: DataFrame, keys: list, values: dict[str, str]) -> DataFrame:
    """keys, the finite values and the exact parts of each; ``values``: name -> source column."""
    plain = df.select(*keys, *[finite(source).alias(name) for name, source in values.items()])
    return plain.select("*", *[p for name in values for p in parts(name, name)])


def _daily(hourly: DataFrame, metrics: tuple[str, ...]) -> DataFrame:
    keys = ["id", F.to_date("DATE").alias("DATE"), "year", "month"]
    values = {f"_v_{m}": m for m in metrics}
    aggregates = [a for v in values for a in (*buffers(v), F.min(v).alias(f"{v}_lo"), F.max(v).alias(f"{v}_hi"))]
    return _with_parts(hourly, keys, values).groupBy(*DAILY_KEYS).agg(*aggregates)


def _daily_outputs(m: str) -> list:
    v = f"_v_{m}"
    return [mean(v).alias(f"avg{m}"), rounded(f"{v}_lo").alias(f"min{m}"), rounded(f"{v}_hi").alias(f"max{m}")]


def daily_rollup(hourly: DataFrame) -> DataFrame:
    """A1: (id, DATE, year, month) -> {avg,min,max} x {TMP,DEW,WIND,SLP}."""
    return _daily(hourly, METRICS).select("id", "DATE", *[o for m in METRICS for o in _daily_outputs(m)], "year", "month")


def daily_rollup_join_form(hourly: DataFrame) -> DataFrame:
    """The same table built as one aggregate per metric, inner-joined on the keys.

    Kept for comparison with ``daily_rollup``: 4 scans, 4 aggregates and 3
    joins instead of one aggregate; equal rows when keys are never NULL.
    """
    tables = [_daily(hourly, (m,)).select(*DAILY_KEYS, *_daily_outputs(m)) for m in METRICS]
    joined = reduce(lambda a, b: a.join(b, list(DAILY_KEYS)), tables)
    measures = [f"{a}{m}" for m in METRICS for a in ("avg", "min", "max")]
    return joined.select("id", "DATE", *measures, "year", "month")


_PERIOD_VALUES = {f"_{a}_{m}": f"{a}{m}" for m in METRICS for a in ("avg", "min", "max")}


def _period_outputs() -> list:
    outs = []
    for m in METRICS:
        outs += [mean(f"_avg_{m}").alias(f"avg{m}"), mean(f"_min_{m}").alias(f"avg_min{m}"), F.col(f"_lo_{m}").alias(f"min{m}"),
                 mean(f"_max_{m}").alias(f"avg_max{m}"), F.col(f"_hi_{m}").alias(f"max{m}")]
    return outs


def _period_sums(daily: DataFrame, keys: tuple[str, ...], gathered: bool) -> DataFrame:
    """Aggregate buffers per period.

    ``gathered``: whether a period's days lie together, as in a table clustered by month; they are then summed before the
    exchange. Elsewhere hardly two of them meet in a task, and the buffers, four times as wide as a day, would be shuffled
    for every day; so the days are, of which a period has at most 366.
    """
    aggregates = [a for v in _PERIOD_VALUES for a in buffers(v)]
    aggregates += [F.min(f"_min_{m}").alias(f"_lo_{m}") for m in METRICS] + [F.max(f"_max_{m}").alias(f"_hi_{m}") for m in METRICS]
    days = daily if gathered else daily.select(*keys, *_PERIOD_VALUES.values()).repartition(*keys)
    return _with_parts(days, list(keys), _PERIOD_VALUES).groupBy(*keys).agg(*aggregates)


def monthly_sums(daily: DataFrame, gathered: bool = False) -> DataFrame:
    """The exact buffers per (id, year, month) that both period tables are finished from."""
    return _period_sums(daily, MONTHLY_KEYS, gathered)


def monthly_of(sums: DataFrame) -> DataFrame:
    """A2 from ``monthly_sums``: no exchange."""
    return sums.select("id", *_period_outputs(), "year", "month")


def yearly_of(sums: DataFrame) -> DataFrame:
    """A3 from ``monthly_sums``: sums of the daily values, not of rounded monthly ones."""
    aggregates = [a for v in _PERIOD_VALUES for a in merged(v)]
    aggregates += [F.min(f"_lo_{m}").alias(f"_lo_{m}") for m in METRICS] + [F.max(f"_hi_{m}").alias(f"_hi_{m}") for m in METRICS]
    return sums.groupBy(*YEARLY_KEYS).agg(*aggregates).select("id", "year", *_period_outputs())


def monthly_rollup(daily: DataFrame) -> DataFrame:
    """A2: (id, year, month) -> 20 measures, from the daily table."""
    return monthly_of(monthly_sums(daily))


def yearly_rollup(daily: DataFrame) -> DataFrame:
    """A3: (id, year) -> 20 measures, from the daily table (not from monthly)."""
    return _period_sums(daily, YEARLY_KEYS, gathered=False).select("id", "year", *_period_outputs())
