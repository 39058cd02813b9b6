import pytest
from pyspark.sql import functions as F

from meteocube.functions.cell import cell_id, round_coord, station_id
from meteocube.functions.calendar import parse_day


@pytest.mark.parametrize("lat,lon,expected", [
    (33.68, -117.87, "12300-6213"),
    (33.21, -117.87, "12300-6213"),   # same whole degree of latitude: same cell (D5)
    (-33.95, 151.18, "5600-33118"),
    (-0.55, 0.29, "8900-18029"),
])
def test_cell_id_examples(spark, lat, lon, expected):
    df = spark.createDataFrame([(lat, lon)], "lat double, lon double")
    got = df.select(cell_id(round_coord("lat"), round_coord("lon")).alias("id")).first().id
    assert got == expected


def test_longitude_code_truncates(spark):
    # Truncation keeps the published grain; station_id rounds instead.
    df = spark.createDataFrame([(-179.99,), (-179.96,)], "lon double")
    rows = df.select(
        F.split(cell_id(F.lit(0.0), "lon"), "-")[1].alias("cut"),
        F.split(station_id(F.lit(0.0), "lon"), "-")[1].alias("rnd"),
    ).collect()
    assert [(r.cut, r.rnd) for r in rows] == [("0", "1"), ("3", "4")]


def test_parse_day_rejects_bad_text():
    with pytest.raises(ValueError):
        parse_day("2020-13-01")
    assert str(parse_day("2020-02-29")) == "2020-02-29"
