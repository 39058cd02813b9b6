import math
import random

import pytest

from meteocube.operators.locations import base_cell_for, level_powers, nearest_place
from meteocube.schema import EARTH_RADIUS_KM


def hav(lat1, lon1, lat2, lon2):
    p1, p2 = math.radians(lat1), math.radians(lat2)
    a = math.sin(math.radians(lat2 - lat1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(
        math.radians(lon2 - lon1) / 2) ** 2
    return 2 * EARTH_RADIUS_KM * math.asin(math.sqrt(min(a, 1.0)))


def brute(points, places):
    out = {}
    for k, la, lo in points:
        out[k] = min(places, key=lambda p: (round(hav(la, lo, p[3], p[4]), 6), p[0]))[0]
    return out


def run(spark, points, places, base):
    pts = spark.createDataFrame(points, "k string, LATITUDE double, LONGITUDE double")
    pl = spark.createDataFrame(places, "place_key long, name string, cc string, lat double, lon double")
    rows = nearest_place(pts, pl, "k", base_cell_deg=base).collect()
    assert len(rows) == len(points)
    return {r.k: r.place_key for r in rows}


def rnd_places(rng, n, clustered=False):
    out = []
    for i in range(n):
        if clustered and i % 2:
            la, lo = rng.uniform(40, 50), rng.uniform(-5, 10)
        else:
            la, lo = rng.uniform(-85, 85), rng.uniform(-180, 180)
        out.append((i, f"P{i}", "XX", round(la, 2), round(lo, 2)))
    return out


@pytest.mark.parametrize("base,key_offset", [(360.0 / 2048, 0), (360.0 / 256, 0), (360.0 / 16, 0), (None, 0),
                                             (360.0 / 256, 2 ** 40), (None, -5)])
def test_grid_matches_brute_force(spark, base, key_offset):
    # keys of any size and sign order ties alike
    rng = random.Random(7)
    places = [(k + key_offset, *rest) for k, *rest in rnd_places(rng, 300, clustered=True)]
    points = [(f"p{i}", round(rng.uniform(-90, 90), 2), round(rng.uniform(-180, 180), 2)) for i in range(400)]
    points += [("e1", 0.0, 179.99), ("e2", 0.0, -180.0), ("e3", 89.99, 12.0), ("e4", -90.0, 0.0),
               ("e5", 45.0, 2.0), ("e6", -60.0, -150.0)]
    assert run(spark, points, places, base) == brute(points, places)


def test_edge_cases(spark):
    places = [(3, "W", "XX", 0.0, -10.0), (5, "E", "XX", 0.0, 10.0), (7, "Date", "XX", 10.0, 179.9),
              (9, "Pole", "XX", 89.5, -100.0)]
    points = [("tie", 0.0, 0.0),            # equidistant: smaller key wins
              ("wrap", 10.0, -179.95),     # nearest across the antimeridian
              ("pole", 89.9, 80.0),        # nearest over the pole
              ("alone", -70.0, 60.0)]      # no place anywhere near
    got = run(spark, points, places, 360.0 / 1024)
    assert got == {"tie": 3, "wrap": 7, "pole": 9, "alone": brute([("alone", -70.0, 60.0)], places)["alone"]}


def test_grid_levels():
    assert level_powers(8) == [1, 2, 4, 6, 8] and level_powers(1) == [1] and level_powers(7, 2) == [1, 2, 3, 4, 5, 6, 7]
    assert base_cell_for(25) == 90.0
    assert base_cell_for(150_000) == 360.0 / 512


def test_every_point_appears_once_even_without_places_or_coordinates(spark):
    pts = spark.createDataFrame([("a", 10.0, 10.0), ("b", None, None)], "k string, LATITUDE double, LONGITUDE double")
    none = spark.createDataFrame([], "place_key long, name string, cc string, lat double, lon double")
    rows = sorted(nearest_place(pts, none, "k").collect())
    assert [(r.k, r.place_key) for r in rows] == [("a", None), ("b", None)]
    some = spark.createDataFrame([(1, "X", "YY", 0.0, 0.0)], "place_key long, name string, cc string, lat double, lon double")
    rows = sorted(nearest_place(pts, some, "k").collect())
    assert [(r.k, r.place_key) for r in rows] == [("a", 1), ("b", None)]


def test_location_dimension_city_null_without_places(spark):
    from meteocube.operators.locations import location_dimension

    from helpers import raw_df

    raw = raw_df(spark, [("2020-01-01 00:00", 33.68, -117.87, 1.0, 1.0, 1.0, 1.0)])
    none = spark.createDataFrame([], "place_key long, name string, cc string, lat double, lon double")
    assert [r.city for r in location_dimension(raw, none).collect()] == [None]


@pytest.mark.parametrize("base", [360.0 / 512, 360.0 / 64, 360.0 / 8])
def test_boundary_heavy_points_match_brute_force(spark, base):
    """Points and places on or next to grid lines of several levels, on the poles and on +-180."""
    rng = random.Random(int(360 / base))
    lines_lat = [-90.0, 90.0] + [k * s - 90 for s in (base, base * 4, base * 16) for k in range(0, int(180 / s) + 1)]
    lines_lon = [-180.0, 180.0] + [k * s - 180 for s in (base, base * 4, base * 16) for k in range(0, int(360 / s) + 1)]

    def near(lines, lo, hi):
        v = rng.choice(lines) + rng.choice([0.0, 0.01, -0.01, 0.02, -0.02])
        return float(round(min(max(v, lo), hi), 2))

    places = [(i, f"P{i}", "XX", near(lines_lat, -90, 90), near(lines_lon, -180, 180)) for i in range(60)]
    points = [(f"p{i}", near(lines_lat, -90, 90), near(lines_lon, -180, 180)) for i in range(300)]
    assert run(spark, points, places, base) == brute(points, places)


def test_invalid_coordinates_get_no_place_and_bad_places_are_ignored(spark):
    pts = spark.createDataFrame([("a", 10.0, 10.0), ("nan", float("nan"), 0.0), ("far", 95.0, 0.0)],
                                "k string, LATITUDE double, LONGITUDE double")
    pl = spark.createDataFrame([(1, "Good", "GG", 11.0, 11.0), (2, "Bad", "BB", float("nan"), 10.0),
                                (3, "Off", "OO", 10.0, 400.0)],
                               "place_key long, name string, cc string, lat double, lon double")
    rows = {r.k: r.place_key for r in nearest_place(pts, pl, "k").collect()}
    assert rows == {"a": 1, "nan": None, "far": None}


def test_copies_at_one_spot_reduce_to_smallest_key(spark):
    # a third of the gazetteer piled on one coordinate: the smallest key of the pile wins, names follow the key
    pile = [(k, f"Copy{k}", "CP", 40.0, 40.0) for k in range(100, 400)]
    others = [(k, f"O{k}", "OO", float(k % 50) - 25.0, float(k % 70) * 2 - 70.0) for k in range(1, 600)]
    pts = [("near", 40.01, 40.0), ("far", -30.0, -60.0)]
    got = run(spark, pts, pile + others, None)
    assert got == brute(pts, pile + others)
    assert got["near"] == 100
    pts_df = spark.createDataFrame(pts, "k string, LATITUDE double, LONGITUDE double")
    pl = spark.createDataFrame(pile + others, "place_key long, name string, cc string, lat double, lon double")
    near = [r for r in nearest_place(pts_df, pl, "k").collect() if r.k == "near"][0]
    assert (near.name, near.cc) == ("Copy100", "CP")


def test_dense_cluster_refines_the_base_grid_and_stays_exact(spark):
    from pyspark.sql import functions as F

    from meteocube.operators.locations import MAX_PLACES_PER_CELL, base_cell_for_occupancy, grid_col, grid_row

    rng = random.Random(3)
    dense = [(i, f"D{i}", "DD", round(35.0 + rng.uniform(0, 0.5), 4), round(139.0 + rng.uniform(0, 0.5), 4))
             for i in range(3000)]
    sparse = [(10000 + i, f"S{i}", "SS", round(rng.uniform(-80, 80), 2), round(rng.uniform(-180, 180), 2))
              for i in range(50)]
    places = dense + sparse
    pl = spark.createDataFrame(places, "place_key long, name string, cc string, lat double, lon double").select(
        F.col("lat").alias("_plat"), F.col("lon").alias("_plon"))
    base = base_cell_for_occupancy(pl, 360.0 / 64)
    assert base < 360.0 / 64
    fullest = pl.groupBy(grid_row(F.col("_plat"), base), grid_col(F.col("_plon"), base)).count().agg(
        F.max("count")).first()[0]
    assert fullest <= MAX_PLACES_PER_CELL
    assert base_cell_for_occupancy(pl.limit(0), 90.0) == 90.0
    pts = [(f"in{i}", round(35.0 + rng.uniform(0, 0.5), 3), round(139.0 + rng.uniform(0, 0.5), 3)) for i in range(40)]
    pts += [(f"near{i}", round(35.8 + rng.uniform(0, 0.3), 3), round(139.7 + rng.uniform(0, 0.3), 3)) for i in range(20)]
    pts += [(f"far{i}", round(rng.uniform(-60, 60), 2), round(rng.uniform(-180, 180), 2)) for i in range(20)]
    assert run(spark, pts, places, None) == brute(pts, places)


def test_sparse_gazetteer_keeps_density_grid(spark):
    from pyspark.sql import functions as F

    from meteocube.operators.locations import base_cell_for, base_cell_for_occupancy

    pl = spark.createDataFrame(rnd_places(random.Random(5), 25), "place_key long, name string, cc string, lat double, lon double")
    pl = pl.select(F.col("lat").alias("_plat"), F.col("lon").alias("_plon"))
    assert base_cell_for_occupancy(pl, base_cell_for(25)) == base_cell_for(25) == 90.0


def test_box_lower_bound_never_exceeds_distance_to_points_in_the_box(spark):
    from pyspark.sql import functions as F

    from meteocube.functions.geo import box_lower_bound_km, grid_shape

    rng = random.Random(17)
    rows = []
    for _ in range(3000):
        size = rng.choice([360.0 / 2 ** k for k in (2, 4, 6, 9)])
        nrows, ncols = grid_shape(size)
        r, c = rng.randrange(nrows), rng.randrange(ncols)
        plat = rng.choice([rng.uniform(-90, 90), rng.uniform(80, 90), rng.uniform(-90, -80)])
        plon = rng.choice([rng.uniform(-180, 180), rng.uniform(175, 180), rng.uniform(-180, -175)])
        qlat = min(r * size - 90 + rng.random() * size, 90.0)
        qlon = c * size - 180 + rng.random() * size
        rows.append((plat, plon, r, c, size, qlat, qlon))
    df = spark.createDataFrame(rows, "plat double, plon double, r int, c int, size double, qlat double, qlon double")
    by_size = []
    for size in sorted({x[4] for x in rows}):
        part = df.filter(F.col("size") == size)
        by_size.append(part.select(
            box_lower_bound_km(F.col("plat"), F.col("plon"), F.col("r"), F.col("c"), size).alias("lb"),
            "plat", "plon", "qlat", "qlon"))
    got = [r for part in by_size for r in part.collect()]
    assert len(got) == len(rows)
    for x in got:
        assert x.lb <= hav(x.plat, x.plon, x.qlat, x.qlon) + 1e-6, x
