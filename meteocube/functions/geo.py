"""Great-circle distance and the lat/lon grid used by the nearest-place join."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import EARTH_RADIUS_KM


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    p1, p2 = F.radians(lat1), F.radians(lat2)
    dphi = F.radians(lat2 - lat1)
    dlmb = F.radians(lon2 - lon1)
    a = F.pow(F.sin(dphi / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlmb / 2), 2)
    return 2 * EARTH_RADIUS_KM * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def grid_shape(cell_deg: float) -> tuple[int, int]:
    """(rows, cols) of a grid of square cells over [-90,90] x [-180,180)."""
    return max(1, math.ceil(180.0 / cell_deg)), max(1, round(360.0 / cell_deg))


def grid_row(lat: Column, cell_deg: float) -> Column:
    rows, _ = grid_shape(cell_deg)
    r = F.floor((lat + 90) / cell_deg)
    return F.least(F.greatest(r, F.lit(0)), F.lit(rows - 1)).cast("int")


def grid_col(lon: Column, cell_deg: float) -> Column:
    _, cols = grid_shape(cell_deg)
    return F.pmod(F.floor((lon + 180) / cell_deg), F.lit(cols)).cast("int")


def box_lower_bound_km(lat: Column, lon: Column, row: Column, col: Column, cell_deg: float) -> Column:
    """The smallest distance from a point to grid cell (row, col) of edge ``cell_deg``; zero inside it.

    Within the cell's longitudes it is the gap along the meridian.  Elsewhere the nearest point lies on the
    nearer bounding meridian: at one of its two corners, or at the foot of the perpendicular
    (latitude atan2(sin lat, cos lat * cos dlon)) when that is between them.
    """
    lat_lo = row * cell_deg - 90
    lat_hi = lat_lo + cell_deg
    lon_lo = col * cell_deg - 180
    lon_hi = lon_lo + cell_deg
    gap = F.radians(F.greatest(lat_lo - lat, lat - lat_hi, F.lit(0.0))) * EARTH_RADIUS_KM
    inside = (lon >= lon_lo) & (lon <= lon_hi)
    dlon = F.least(F.pmod(lon_lo - lon, F.lit(360.0)), F.pmod(lon - lon_hi, F.lit(360.0)))
    foot = F.degrees(F.atan2(F.sin(F.radians(lat)), F.cos(F.radians(lat)) * F.cos(F.radians(dlon))))
    to = lambda at: haversine_km(lat, F.lit(0.0), at, dlon)
    return F.when(inside, gap).otherwise(F.least(to(lat_lo), to(lat_hi), F.when((foot >= lat_lo) & (foot <= lat_hi), to(foot))))
