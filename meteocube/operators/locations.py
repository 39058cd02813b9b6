"""Station cells, location dimension and nearest-place lookup.

Nearest place, exactly, by descending a hierarchy of cells
----------------------------------------------------------
Places are bucketed on a lat/lon grid of cells 360/2^k degrees (fine enough that no cell holds more than
MAX_PLACES_PER_CELL places, down to 360/2^FINEST_K degrees; one aggregate over all grids tells), and one table holds the
occupied cells of every grid of the hierarchy, each with one of its places as representative.

A point starts with the two cells of the coarsest grid.  At each level its cells are joined to their occupied
child cells, the distances to the children's representatives give an upper bound of the distance to
the nearest place, and a child stays only if the lower bound of its distance does not exceed that.  So a point
carries a small frontier of cells from level to level, never the cells of a whole block, and on the finest grid only
the places of the frontier's cells are joined.  The nearest place always lies in the frontier: the result is
exact for any input.  Levels join cells, whose number on a grid is bounded by the grid itself (2^(2k-1)) and by
the number of places; they are broadcast while that bound is small.

Ties: distance rounded to 1e-6 km, then the smaller ``place_key`` wins, for keys of any type, so copies at identical
coordinates are reduced to their smallest key before the join.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import box_lower_bound_km, grid_col, grid_row, haversine_km
from ..session import scratch_path
from .hourly import split_rejects, valid_coordinates, with_station_key
from .joins import MAX_BROADCAST_ROWS

BASE_CELL_DEG = None              # None: pick from the gazetteer's density
GROWTH = 4                        # cell edge multiplier between levels
_PRUNE_MARGIN_KM = 1e-3           # slack on the cell bounds for floating-point error
MAX_PLACES_PER_CELL = 256         # base grid: no cell holds more places than this (if 360/2^FINEST_K allows)
FINEST_K = 24                     # finest grid considered: 360/2^24 degrees (~2 m)


def base_cell_for(n_places: int) -> float:
    """Finest grid 360/2^k whose cell count does not exceed the number of places.

    About one place per cell on average: a dense gazetteer (1e5 places) starts
    at ~0.7 degree, a handful of places at 90 degrees.
    """
    k = int((math.log2(max(n_places, 1)) + 1) // 2)
    return 360.0 / 2 ** min(max(k, 1), FINEST_K)


def grid_statistics(spots: DataFrame) -> tuple[int, dict[int, int]]:
    """(number of places, places in the fullest cell of every grid k = 1 .. FINEST_K).

    ``spots`` has (_plat, _plon).  One aggregate over the places exploded to all grids; FINEST_K rows reach the driver.
    """
    per_cell = _on_grids(spots, range(1, FINEST_K + 1)).groupBy("k", "gr", "gc").count()
    rows = per_cell.groupBy("k").agg(F.max("count").alias("most"), F.sum("count").alias("all")).collect()
    return (rows[0]["all"] if rows else 0), {r["k"]: r["most"] for r in rows}


def _on_grids(spots: DataFrame, powers) -> DataFrame:
    """(_plat, _plon, k, gr, gc): every place with its cell on each of the grids 360/2^k."""
    ks = F.explode(F.array(*[F.lit(k) for k in powers])).alias("k")
    size, row, col = "(360.0D / shiftleft(1L, k))", "floor((_plat + 90.0D) / {0})", "floor((_plon + 180.0D) / {0})"
    return spots.select("_plat", "_plon", ks).select(
        "_plat", "_plon", "k",
        F.expr(f"cast(least(greatest({row.format(size)}, 0L), shiftleft(1L, k - 1) - 1) AS int)").alias("gr"),
        F.expr(f"cast(pmod({col.format(size)}, shiftleft(1L, k)) AS int)").alias("gc"))


def coarsest_within(fullest: dict[int, int], coarsest: float, cap: int = MAX_PLACES_PER_CELL) -> float:
    """Coarsest grid 360/2^k (not coarser than ``coarsest``) whose fullest cell holds at most ``cap`` places.

    A dense city then starts on a fine grid, so stations inside it see few candidates, while a sparse gazetteer
    keeps the density-chosen grid.
    """
    ks = [k for k in range(1, FINEST_K + 1) if 360.0 / 2 ** k <= coarsest]
    for k in ks:  # coarse to fine
        if fullest.get(k, 0) <= cap:
            return 360.0 / 2 ** k
    return 360.0 / 2 ** ks[-1] if ks else coarsest


def base_cell_for_occupancy(places: DataFrame, coarsest: float, cap: int = MAX_PLACES_PER_CELL) -> float:
    """``coarsest_within`` for places with (_plat, _plon)."""
    return coarsest_within(grid_statistics(places)[1], coarsest, cap)


def cell_power(cell_deg: float) -> int:
    """k of a cell edge 360/2^k; ValueError for an edge that does not divide the globe this way."""
    k = round(math.log2(360.0 / cell_deg)) if cell_deg > 0 else 0
    if not 1 <= k <= FINEST_K or 360.0 / 2 ** k != cell_deg:
        raise ValueError(f"cell edges are 360/2^k degrees with k from 1 to {FINEST_K}, got {cell_deg!r}")
    return k


def level_powers(base_k: int, growth: int = GROWTH) -> list[int]:
    """Grids of the hierarchy from the coarsest (k = 1: two cells) to the base, as powers k."""
    step = int(growth).bit_length() - 1
    if step < 1 or 2 ** step != growth:
        raise ValueError(f"growth must be a power of two and at least 2, got {growth!r}")
    return [1, *sorted(k for k in range(base_k, 1, -step))] if base_k > 1 else [1]


def station_cells(raw: DataFrame, id_mode: str = "cell") -> DataFrame:
    """A4: distinct (id, LONGITUDE, LATITUDE) of the readings."""
    valid, _ = split_rejects(raw.select("DATE", "LATITUDE", "LONGITUDE"))
    return with_station_key(valid, id_mode).select("id", "LONGITUDE", "LATITUDE").distinct()


def nearest_place(points: DataFrame, places: DataFrame, key: str = "id", lat: str = "LATITUDE",
                  lon: str = "LONGITUDE", base_cell_deg: float | None = BASE_CELL_DEG,
                  growth: int = GROWTH, on_globe: bool = False) -> DataFrame:
    """For each point (unique ``key``), the nearest place of ``places``.

    ``places`` has (place_key, name, cc, lat, lon).  Returns every column of
    ``points`` plus (place_key, name, cc, distance_km); one row per key.
    ``on_globe``: the caller has checked that every point has valid coordinates.
    """
    cand, cols = candidates(points, places, key, lat, lon, base_cell_deg, growth, on_globe)
    dist = F.round(haversine_km(F.col(lat), F.col(lon), F.col("_plat"), F.col("_plon")), 6)
    order = F.when(F.col("place_key").isNotNull(), F.struct(dist.alias("distance_km"), F.col("place_key")))
    found = cand.groupBy(*cols).agg(F.min(order).alias("_best")).select(*cols, "_best.place_key", "_best.distance_km")
    names = _valid(places).groupBy("place_key").agg(F.min(F.struct("name", "cc")).alias("_nc"))
    found = found.join(names.select("place_key", "_nc.name", "_nc.cc"), "place_key", "left")
    return found.select(*cols, "place_key", "name", "cc", "distance_km")


def _valid(places: DataFrame) -> DataFrame:
    return places.filter(valid_coordinates("lat", "lon") & F.col("place_key").isNotNull())


def candidates(points: DataFrame, places: DataFrame, key: str = "id", lat: str = "LATITUDE", lon: str = "LONGITUDE",
               base_cell_deg: float | None = BASE_CELL_DEG, growth: int = GROWTH, on_globe: bool = False) -> tuple[DataFrame, list[str]]:
    """(point columns, place_key, _plat, _plon) of the places left to compare, and the point columns.

    A point without valid coordinates, or any point when there are no places, keeps one row without a place.
    """
    if base_cell_deg is not None:
        cell_power(base_cell_deg)
    level_powers(1, growth)
    # Copies at identical coordinates tie on every distance, and ties go to the smaller key: keep only that one.
    spots = _valid(places).groupBy(F.col("lat").alias("_plat"), F.col("lon").alias("_plon")).agg(F.min("place_key").alias("place_key"))
    spots = _written(spots, "spots")
    n_spots, fullest = grid_statistics(spots)
    cols = [key, lat, lon, *[c for c in points.columns if c not in (key, lat, lon)]]
    nothing = [F.lit(None).cast(t).alias(n) for n, t in (("place_key", places.schema["place_key"].dataType), ("_plat", "double"), ("_plon", "double"))]
    if not n_spots:
        return points.select(*cols, *nothing), cols
    ok = F.lit(True) if on_globe else F.coalesce(valid_coordinates(lat, lon), F.lit(False))
    if base_cell_deg is None:
        base_cell_deg = coarsest_within(fullest, base_cell_for(n_spots))
    powers = level_powers(cell_power(base_cell_deg), growth)
    # Every level's occupied cells in one table, each with one of its places as representative.
    cells = _on_grids(spots, powers).groupBy("k", "gr", "gc").agg(F.min(F.struct("_plat", "_plon")).alias("_r"))
    cells = _written(cells.select("k", "gr", "gc", F.col("_r._plat").alias("_rlat"), F.col("_r._plon").alias("_rlon")), "cells")

    top = F.array(*[F.struct(F.lit(0).alias("gr"), F.lit(c).alias("gc")) for c in (0, 1)])
    front = points.filter(ok).select(*cols, F.explode(top).alias("_c"))
    front = front.select(*cols, F.col("_c.gr").alias("pr"), F.col("_c.gc").alias("pc"))
    for i, k in enumerate(powers):
        front = _descend(front, _level_cells(cells, k, powers[i - 1] if i else k), cols, lat, lon, k, min(n_spots, 2 ** (2 * k - 1)))
    spots = spots.withColumns({"gr": grid_row(F.col("_plat"), base_cell_deg), "gc": grid_col(F.col("_plon"), base_cell_deg)})
    spots = spots.withColumnsRenamed({"gr": "pr", "gc": "pc"})
    if n_spots <= MAX_BROADCAST_ROWS:
        spots = F.broadcast(spots)
    found = front.join(spots, ["pr", "pc"]).select(*cols, "place_key", "_plat", "_plon")
    return (found if on_globe else found.union(points.filter(~ok).select(*cols, *nothing))), cols


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, f"nearest-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _level_cells(cells: DataFrame, k: int, parent: int) -> DataFrame:
    """Occupied cells of grid k with their cell (pr, pc) on the grid ``parent`` and one representative place each."""
    over = 2 ** (k - parent)
    div = lambda c: F.floor(F.col(c) / over).cast("int")
    return cells.filter(F.col("k") == k).select(div("gr").alias("pr"), div("gc").alias("pc"), "gr", "gc", "_rlat", "_rlon")


def _descend(front: DataFrame, cells: DataFrame, cols: list[str], lat: str, lon: str, k: int, most_cells: int) -> DataFrame:
    """The frontier's occupied cells on grid k that may hold the nearest place, as (cols, pr, pc)."""
    if most_cells <= MAX_BROADCAST_ROWS:
        cells = F.broadcast(cells)
    met = front.join(cells, ["pr", "pc"])
    upper = F.min(haversine_km(F.col(lat), F.col(lon), F.col("_rlat"), F.col("_rlon"))).over(Window.partitionBy(cols[0]))
    lower = box_lower_bound_km(F.col(lat), F.col(lon), F.col("gr"), F.col("gc"), 360.0 / 2 ** k)
    return met.withColumn("_upper", upper).filter(lower <= F.col("_upper") + _PRUNE_MARGIN_KM).select(*cols, F.col("gr").alias("pr"), F.col("gc").alias("pc"))


def place_label(name: str = "name", cc: str = "cc") -> F.Column:
    """P12: 'name, cc' (NULL when no place was found)."""
    return F.when(F.col(name).isNotNull(), F.concat_ws(", ", F.col(name), F.col(cc)))


def locate(cells: DataFrame, places: DataFrame, base_cell_deg: float | None = BASE_CELL_DEG) -> DataFrame:
    """Every distinct valid coordinate (id, LONGITUDE, LATITUDE) with its nearest city: the per-point form of the dimension."""
    pts = cells.withColumn("_pt", F.concat_ws("|", "LATITUDE", "LONGITUDE"))
    near = nearest_place(pts, places, "_pt", "LATITUDE", "LONGITUDE", base_cell_deg, on_globe=True)
    return near.select("LATITUDE", "LONGITUDE", place_label().alias("city"), "id")


def one_per_station(points: DataFrame) -> DataFrame:
    """One row per station key (D7): representative point, its city, point count.

    The representative point of a key is its smallest (LATITUDE, LONGITUDE);
    ``n_points`` counts the distinct coordinates that share the key.
    """
    rep = points.groupBy("id").agg(F.min(F.struct("LATITUDE", "LONGITUDE", "city")).alias("_p"), F.count(F.lit(1)).alias("n_points"))
    return rep.select("_p.LATITUDE", "_p.LONGITUDE", "_p.city", "id", "n_points")


def location_dimension(raw: DataFrame, places: DataFrame, id_mode: str = "cell",
                       base_cell_deg: float | None = BASE_CELL_DEG) -> DataFrame:
    """One row per station key of the readings (see ``one_per_station``)."""
    return one_per_station(located_points(raw, places, id_mode, base_cell_deg))


def located_points(raw: DataFrame, places: DataFrame, id_mode: str = "cell",
                   base_cell_deg: float | None = BASE_CELL_DEG) -> DataFrame:
    """Every distinct coordinate of the readings with its id and nearest city."""
    return locate(station_cells(raw, id_mode), places, base_cell_deg)
