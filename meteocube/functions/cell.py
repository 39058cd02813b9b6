"""Grid-cell keys of a station."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_coord(c: Column | str) -> Column:
    """Coordinates are kept at 0.01 degree."""
    return F.round(F.col(c) if isinstance(c, str) else c, 2)


def cell_id(lat: Column | str, lon: Column | str) -> Column:
    """Published station key ``LLL00-OOOOO``.

    Latitude is cut to a whole degree and then scaled by 100; longitude is cut
    at 0.01 degree.  Both cuts truncate (not round), which is what defines the
    published grain, so stations in one whole degree of latitude with the same
    longitude share a key.  Inputs are expected already rounded to 2 places.
    """
    lat = F.col(lat) if isinstance(lat, str) else lat
    lon = F.col(lon) if isinstance(lon, str) else lon
    lat_code = (lat + 90).cast("int") * 100
    lon_code = ((lon + 180) * 100).cast("int")
    return F.concat_ws("-", lat_code.cast("string"), lon_code.cast("string"))


def station_id(lat: Column | str, lon: Column | str) -> Column:
    """Collision-free alternative key: 0.01 degree on both axes, rounded."""
    lat = F.col(lat) if isinstance(lat, str) else lat
    lon = F.col(lon) if isinstance(lon, str) else lon
    lat_code = F.round((lat + 90) * 100).cast("int")
    lon_code = F.round((lon + 180) * 100).cast("int")
    return F.concat_ws("-", lat_code.cast("string"), lon_code.cast("string"))
