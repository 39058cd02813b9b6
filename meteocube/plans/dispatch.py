"""Single entry point (Q10): request -> checked arguments -> one of Q1-Q8."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from ..functions.calendar import parse_day
from ..operators.guard import OK, check_result, fetch
from ..schema import LEVELS, LIMITS, ROW_LIMIT
from .build import Cube
from .queries import TIME_COLUMNS, series, snapshot, value_column


def check_request(level: str, metric: str, agg: str, start, end, station: str | None = None,
                  limits: Mapping[str, int] | None = LIMITS) -> None:
    """Argument rules of a request; raises ValueError with the reason.

    ``limits`` bounds the days of a request, as the published front does; None accepts any range.
    """
    s, e = parse_day(start), parse_day(end)
    if s > e:
        raise ValueError("invalid date: start after end")
    if level not in LEVELS:
        raise ValueError("level can't be empty" if not level else f"invalid level {level!r}")
    if level != "hourly" and not agg:
        raise ValueError("aggregation method can't be empty")
    value_column(level, agg, metric)
    kind = f"{level}_{'series' if (station or '').strip() else 'snapshot'}"
    most = (limits or {}).get(kind)
    if most is not None and (e - s).days > most:
        raise ValueError(f"at most {most} days of a {kind.replace('_', ' ')}")


def query(cube: Cube, level: str, metric: str, agg: str, start, end, station: str | None = None,
          ordered: bool = True, limits: Mapping[str, int] | None = LIMITS) -> DataFrame:
    """Series for one station when ``station`` is given, else a snapshot of all."""
    check_request(level, metric, agg, start, end, station, limits)
    table = cube.table(level)
    station = (station or "").strip()
    if station:
        return series(table, level, metric, agg, start, end, station, ordered)
    return snapshot(table, cube.locations(), level, metric, agg, start, end, ordered, cube.location_rows)


def answer(cube: Cube, level: str, metric: str, agg: str, start, end, station: str | None = None,
           cap: int | None = ROW_LIMIT, limits: Mapping[str, int] | None = LIMITS, collect: bool = True):
    """The request's answer for a caller: (status, pandas frame or None), evaluated once.

    With ``cap=None`` the whole answer stays distributed: ('ok', ordered DataFrame). With ``collect=False`` it is
    counted against the cap and stays distributed and unordered: (status, DataFrame or None).
    """
    if cap is None:
        return OK, query(cube, level, metric, agg, start, end, station, limits=limits)
    df = query(cube, level, metric, agg, start, end, station, ordered=False, limits=limits)
    if not collect:
        status = check_result(df, cap)
        return status, (df if status == OK else None)
    return fetch(df, [c for c in (*TIME_COLUMNS[level], "id") if c in df.columns], cap)
