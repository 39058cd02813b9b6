"""DuckDB SQL for every registered query (the correctness oracle).

Plain SQL over the driver's tables, written independently of the Spark code:
brute-force where Spark uses a smarter plan (e.g. the nearest place is a full
cross product ranked per station here).  A reading is the decimal that its text
spells; sums are exact decimals and a mean is rounded once, from the raw readings,
half away from zero, in integers.
"""

from __future__ import annotations

from ..schema import LEVELS, METRICS, ROW_LIMIT

R_KM = "12742.0::DOUBLE"  # 2 * earth radius


def _dec(x: str) -> str:
    """The decimal number that a finite reading's text spells."""
    return (f"(CASE WHEN abs({x}) >= 9007199254740992 AND isfinite({x}) THEN CAST(CAST({x} AS HUGEINT) AS DECIMAL(38, 12)) "
            f"WHEN isfinite({x}) THEN CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 12)) END)")


def _two_places(units: str) -> str:
    """A double from a whole number of hundredths (HUGEINT), by way of its text: correctly rounded at any size."""
    size = f"abs({units})"
    return (f"CAST((CASE WHEN {units} < 0 THEN '-' ELSE '' END) || CAST({size} // 100 AS VARCHAR) || '.' || "
            f"lpad(CAST({size} % 100 AS VARCHAR), 2, '0') AS DOUBLE)")


def _hundredths(total: str, n: str = "1") -> str:
    """total / n in hundredths, half away from zero: integer division of the sum's digits (12 decimals)."""
    digits = f"CAST(replace(CAST({total} AS VARCHAR), '.', '') AS HUGEINT)"
    step = f"(CAST({n} AS HUGEINT) * 10000000000)"
    return f"((CASE WHEN {total} < 0 THEN -1 ELSE 1 END) * ((2 * abs({digits}) + {step}) // (2 * {step})))"


def _mean(s: str, n: str) -> str:
    return f"CASE WHEN {n} > 0 THEN {_two_places(_hundredths(s, n))} END"


def _val(c: str) -> str:
    return f"CASE WHEN {c} IS NOT NULL THEN {_two_places(_hundredths(c))} END"


STATIONS = """stations AS (
  SELECT s_suppkey AS station_key,
    CAST(((s_suppkey // 2) * 731) % 16000 - 8000 + (s_suppkey % 2) * 20 AS DOUBLE) / 100 AS LATITUDE,
    CAST(((s_suppkey // 2) * 1237) % 36000 - 18000 AS DOUBLE) / 100 AS LONGITUDE
  FROM supplier)"""

OBS_LINEITEM = """obs_li AS (
  SELECT l_shipdate AS DATE, LATITUDE, LONGITUDE, l_extendedprice AS TMP, l_quantity AS DEW,
         l_discount AS WND_RATE, l_tax AS SLP
  FROM lineitem JOIN stations ON l_suppkey = station_key)"""



def obs_events(value: str = "value") -> str:
    return f"""obs_ev AS (
  SELECT ts AS DATE, LATITUDE, LONGITUDE,
    CASE WHEN event_type = 'click' THEN {value} END AS TMP,
    CASE WHEN event_type = 'view' THEN {value} END AS DEW,
    CASE WHEN event_type = 'purchase' THEN {value} END AS WND_RATE,
    CASE WHEN event_type = 'error' THEN {value} END AS SLP
  FROM events JOIN stations ON user_id % (SELECT count(*) FROM supplier) = station_key)"""


OBS_EVENTS = obs_events()

PLACES = """places AS (
  SELECT CAST(n_nationkey AS BIGINT) AS place_key, n_name AS name, substr(n_name, 1, 2) AS cc,
    CAST((n_nationkey * 2311) % 16001 - 8000 AS DOUBLE) / 100 AS lat,
    CAST((n_nationkey * 7127) % 36001 - 18000 AS DOUBLE) / 100 AS lon
  FROM nation)"""


VALID = "DATE IS NOT NULL AND LATITUDE BETWEEN -90 AND 90 AND LONGITUDE BETWEEN -180 AND 180"


def _id(lat: str = "LATITUDE", lon: str = "LONGITUDE") -> str:
    return (f"concat_ws('-', CAST(CAST(trunc({lat} + 90) AS INTEGER) * 100 AS VARCHAR), "
            f"CAST(CAST(trunc(({lon} + 180) * 100) AS INTEGER) AS VARCHAR))")


def _station_id(lat: str, lon: str) -> str:
    return (f"concat_ws('-', CAST(CAST(round(({lat} + 90) * 100) AS INTEGER) AS VARCHAR), "
            f"CAST(CAST(round(({lon} + 180) * 100) AS INTEGER) AS VARCHAR))")


def hourly_cte(obs: str, name: str = "hourly", station: bool = False) -> str:
    key = (_station_id if station else _id)('round(LATITUDE, 2)', 'round(LONGITUDE, 2)')
    return f"""{name} AS (
  SELECT DATE, TMP, DEW, WND_RATE AS WIND, SLP, {key} AS id,
         CAST(year(DATE) AS INTEGER) AS year, CAST(month(DATE) AS INTEGER) AS month
  FROM {obs} WHERE {VALID})"""


def daily_cte(hourly: str = "hourly", name: str = "daily") -> str:
    cents = ", ".join(f"{_dec(m)} AS c_{m}" for m in METRICS)
    bufs = ", ".join(f"sum(c_{m}) AS s_{m}, count(c_{m}) AS n_{m}, min(c_{m}) AS lo_{m}, max(c_{m}) AS hi_{m}"
                     for m in METRICS)
    outs = ", ".join(f"{_mean(f's_{m}', f'n_{m}')} AS avg{m}, {_val(f'lo_{m}')} AS min{m}, "
                     f"{_val(f'hi_{m}')} AS max{m}" for m in METRICS)
    return f"""{name} AS (
  SELECT id, DATE, {outs}, year, month FROM (
    SELECT id, DATE, year, month, {bufs}
    FROM (SELECT id, CAST(DATE AS DATE) AS DATE, year, month, {cents} FROM {hourly})
    GROUP BY id, DATE, year, month))"""


def period_cte(keys: list[str], daily: str = "daily", name: str = "monthly") -> str:
    k = ", ".join(keys)
    cents = ", ".join(f"{_dec('avg' + m)} AS a_{m}, {_dec('min' + m)} AS lo_{m}, {_dec('max' + m)} AS hi_{m}"
                      for m in METRICS)
    bufs = ", ".join(
        f"sum(a_{m}) AS sa_{m}, count(a_{m}) AS na_{m}, sum(lo_{m}) AS slo_{m}, count(lo_{m}) AS nlo_{m}, "
        f"min(lo_{m}) AS mlo_{m}, sum(hi_{m}) AS shi_{m}, count(hi_{m}) AS nhi_{m}, max(hi_{m}) AS mhi_{m}"
        for m in METRICS)
    outs = ", ".join(
        f"{_mean(f'sa_{m}', f'na_{m}')} AS avg{m}, {_mean(f'slo_{m}', f'nlo_{m}')} AS avg_min{m}, "
        f"{_val(f'mlo_{m}')} AS min{m}, {_mean(f'shi_{m}', f'nhi_{m}')} AS avg_max{m}, {_val(f'mhi_{m}')} AS max{m}"
        for m in METRICS)
    return f"""{name} AS (
  SELECT {k}, {outs} FROM (
    SELECT {k}, {bufs} FROM (SELECT {k}, {cents} FROM {daily}) GROUP BY {k}))"""


def _haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = (f"pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) * "
         f"pow(sin(radians({lon2} - {lon1}) / 2), 2)")
    return f"{R_KM} * asin(sqrt(least({a}, 1.0)))"


def cells_cte(obs: str, name: str = "cells") -> str:
    return f"""{name} AS (
  SELECT DISTINCT {_id()} AS id, LONGITUDE, LATITUDE FROM (
    SELECT round(LATITUDE, 2) AS LATITUDE, round(LONGITUDE, 2) AS LONGITUDE FROM {obs}
    WHERE {VALID}))"""


def nearest_cte(points: str, keys: list[str], name: str) -> str:
    d = _haversine("p.LATITUDE", "p.LONGITUDE", "g.lat", "g.lon")
    part = ", ".join(f"p.{k}" for k in keys)
    return f"""{name} AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT p.*, g.name || ', ' || g.cc AS city,
      row_number() OVER (PARTITION BY {part} ORDER BY round({d}, 6), g.place_key) AS rn
    FROM {points} p CROSS JOIN places g) WHERE rn = 1)"""


def locations_cte(cells: str = "cells", name: str = "locations") -> str:
    return f"""{nearest_cte(cells, ['LATITUDE', 'LONGITUDE'], 'points')},
{name} AS (
  SELECT id, LATITUDE, LONGITUDE, city, n_points FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY LATITUDE, LONGITUDE) AS rn,
           count(*) OVER (PARTITION BY id) AS n_points
    FROM points) WHERE rn = 1)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# Common prefixes -----------------------------------------------------------
LI_DAILY = [STATIONS, OBS_LINEITEM, hourly_cte("obs_li"), daily_cte()]
ALL_OBS = [STATIONS, OBS_LINEITEM, OBS_EVENTS, "obs AS (SELECT * FROM obs_li UNION ALL SELECT * FROM obs_ev)"]
CUBE = [*ALL_OBS, hourly_cte("obs"), daily_cte(), period_cte(["id", "year", "month"], "daily", "monthly"),
        period_cte(["id", "year"], "daily", "yearly"), PLACES, cells_cte("obs"), locations_cte()]


def snapshot_sql(level: str, col: str, where: str, time_sel: str) -> str:
    assert level in LEVELS
    table, val = level, f"round({col}, 2) AS {col}" if level == "hourly" else col
    return with_(*CUBE) + f"""SELECT {time_sel}, f.id, {val}, l.city, l.LATITUDE, l.LONGITUDE
FROM (SELECT * FROM {table} WHERE {where}) f LEFT JOIN locations l ON f.id = l.id"""


def series_sql(level: str, col: str, where: str, time_sel: str, station: str) -> str:
    assert level in LEVELS
    table, val = level, f"round({col}, 2) AS {col}" if level == "hourly" else col
    return with_(*CUBE) + f"SELECT {time_sel}, {val} FROM {table} WHERE {where} AND id = '{station}'"


def month_sel(prefix: str = "") -> str:
    y, m = f"{prefix}year", f"{prefix}month"
    return f"{y} * 100 + {m} AS year_month, strftime(make_date({y}, {m}, 1), '%Y %b') AS label"


def guard_sql(name: str, inner: str) -> str:
    return (f"SELECT '{name}' AS query, count(*) AS n_rows, "
            f"CASE WHEN count(*) = 0 THEN 'No Data' WHEN count(*) > {ROW_LIMIT} THEN 'Too Large' ELSE 'ok' END "
            f"AS status FROM ({inner})")


# Readings with cells that do not parse, some blank, and missing keys (see catalog._with_bad_cells).
BAD_TEXT = """
SELECT column_name, CAST(n AS BIGINT) AS n_bad FROM (VALUES
  ('DATE', (SELECT count(*) FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE l_orderkey % 50 = 7)),
  ('LATITUDE', (SELECT count(*) FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE l_orderkey % 40 = 3)),
  ('LONGITUDE', 0),
  ('TMP', (SELECT count(*) FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE l_linenumber = 3)),
  ('DEW', (SELECT count(*) FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE l_linenumber = 2)),
  ('WND_RATE', 0), ('SLP', 0)) t(column_name, n)"""

REJECTS = with_(STATIONS) + """
SELECT CASE WHEN l_orderkey % 50 <> 7 THEN l_shipdate END AS DATE, CASE WHEN l_orderkey % 40 <> 3 THEN LATITUDE END AS LATITUDE, LONGITUDE,
       CASE WHEN l_linenumber NOT IN (3, 4) THEN l_extendedprice END AS TMP, CASE WHEN l_linenumber <> 2 THEN l_quantity END AS DEW,
       l_discount AS WIND, CASE WHEN l_linenumber <> 1 THEN l_tax END AS SLP
FROM lineitem JOIN stations ON l_suppkey = station_key WHERE l_orderkey % 50 = 7 OR l_orderkey % 40 = 3"""
