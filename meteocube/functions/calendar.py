"""Calendar columns and range predicates.

Every range predicate carries a conjunct on the ``year``/``month`` partition
columns so that a scan of a table partitioned by (year, month) prunes whole
directories; the exact bound on ``DATE`` is pushed to the parquet reader.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_day(value: str | dt.date | dt.datetime) -> dt.date:
    """'yyyy-MM-dd' (or a date) -> date.  Raises ValueError on bad text."""
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.datetime.strptime(str(value).strip(), "%Y-%m-%d").date()


def year_month_code(year: str = "year", month: str = "month") -> Column:
    """year*100+month, e.g. 199701."""
    return F.col(year) * 100 + F.col(month)


def period_label(year: str = "year", month: str = "month") -> Column:
    """'1997 Jan' style label of a month."""
    return F.date_format(F.make_date(F.col(year), F.col(month), F.lit(1)), "yyyy MMM")


def _month_span(start: dt.date, end: dt.date) -> Column:
    return year_month_code().between(start.year * 100 + start.month, end.year * 100 + end.month)


def day_range(start, end, date_col: str = "DATE") -> Column:
    """Closed interval [start, end] by calendar day on a DATE column (F1)."""
    s, e = parse_day(start), parse_day(end)
    return _month_span(s, e) & F.col(date_col).between(F.lit(s), F.lit(e))


def hour_range(start, end, ts_col: str = "DATE") -> Column:
    """From start 00:00 up to the end of the end day on a timestamp (F2)."""
    s, e = parse_day(start), parse_day(end)
    # Bounds from text: a Python datetime literal would pass through the local/session time zone.
    lo = F.lit(f"{s.isoformat()} 00:00:00").cast("timestamp_ntz")
    hi = F.lit(f"{(e + dt.timedelta(days=1)).isoformat()} 00:00:00").cast("timestamp_ntz")
    ts = F.col(ts_col)
    return _month_span(s, e) & (ts >= lo) & (ts < hi)


def month_range(start, end) -> Column:
    """Whole months from the start month to the end month; days ignored."""
    return _month_span(parse_day(start), parse_day(end))


def year_range(start, end, year_col: str = "year") -> Column:
    """Whole years; months and days ignored."""
    s, e = parse_day(start), parse_day(end)
    return F.col(year_col).between(s.year, e.year)
