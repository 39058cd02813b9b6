"""Raw observations and a gazetteer derived from the driver's test tables.

The cube's natural input is a table of station readings (time, coordinates,
four measures) plus a place table.  The test data is TPC-H shaped, so these
readers map it onto that shape (see FIXTURES.md, part 2):

* stations from ``supplier`` (two suppliers per longitude, 0.20 deg apart);
* multi-year daily-grain readings from ``lineitem`` joined to its supplier;
* sub-daily readings from ``events`` (station = user_id mod #suppliers,
  one measure per event type, the others NULL);
* places from ``nation``.

All of it is Spark work over the whole tables; the station join is a
size-checked broadcast with a shuffle join beyond the bound.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import join_small
from ..schema import RAW_WIND

# --- fixed values of the test-data mapping ---
STATION_LAT_STEP = 731
STATION_LAT_MOD = 16000
STATION_LON_STEP = 1237
STATION_LON_MOD = 36000
PAIR_LAT_OFFSET = 20          # hundredths of a degree between the two stations of a pair
PLACE_LAT_STEP, PLACE_LAT_MOD = 2311, 16001
PLACE_LON_STEP, PLACE_LON_MOD = 7127, 36001
EVENT_MEASURE = {"click": "TMP", "view": "DEW", "purchase": RAW_WIND, "error": "SLP"}
SERIES_ID = "1700-1237"       # suppliers 2 and 3, present at every scale
# --- end of fixed values ---


TABLES = ("supplier", "lineitem", "events", "nation")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def state(spark: SparkSession, sf_dir: str) -> tuple:
    """Files, sizes and times of the tables that a cube is built from: tells a changed input from the same one."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    found = []
    for name in TABLES:
        path = jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
        for f in path.getFileSystem(conf).listStatus(path):
            found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(found))


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """supplier -> (station_key, LATITUDE, LONGITUDE)."""
    k = F.col("s_suppkey")
    half = F.expr("s_suppkey div 2")
    lat = ((half * STATION_LAT_STEP) % STATION_LAT_MOD - 8000 + (k % 2) * PAIR_LAT_OFFSET) / 100.0
    lon = ((half * STATION_LON_STEP) % STATION_LON_MOD - 18000) / 100.0
    return table(spark, sf_dir, "supplier").select(
        k.alias("station_key"), lat.alias("LATITUDE"), lon.alias("LONGITUDE")
    )


def lineitem_observations(spark: SparkSession, sf_dir: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """One reading per lineitem: DATE=l_shipdate, TMP=price, DEW=qty, WIND=discount, SLP=tax (and ``extra`` columns)."""
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("station_key"),
        F.col("l_shipdate").alias("DATE"),
        F.col("l_extendedprice").alias("TMP"),
        F.col("l_quantity").alias("DEW"),
        F.col("l_discount").alias(RAW_WIND),
        F.col("l_tax").alias("SLP"),
        *extra,
    )
    st = stations(spark, sf_dir)
    obs = join_small(li, st, "station_key", "inner")
    return obs.select("DATE", "LATITUDE", "LONGITUDE", "TMP", "DEW", RAW_WIND, "SLP", *extra)


def event_observations(spark: SparkSession, sf_dir: str, value: Callable[[Column], Column] = lambda v: v) -> DataFrame:
    """Sub-daily readings from events; the event type picks which measure is set to ``value`` of the event's value."""
    sup = table(spark, sf_dir, "supplier")
    n_stations = sup.select(F.count(F.lit(1))).scalar()
    ev = table(spark, sf_dir, "events")
    measures = {
        m: F.when(F.col("event_type") == t, value(F.col("value"))).cast("double").alias(m)
        for t, m in EVENT_MEASURE.items()
    }
    readings = ev.select(
        (F.col("user_id") % n_stations).alias("station_key"),
        F.col("ts").alias("DATE"),
        *[measures[m] for m in ("TMP", "DEW", RAW_WIND, "SLP")],
    )
    obs = join_small(readings, stations(spark, sf_dir), "station_key", "inner")
    return obs.select("DATE", "LATITUDE", "LONGITUDE", "TMP", "DEW", RAW_WIND, "SLP")


def nation_gazetteer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation -> places (place_key, name, cc, lat, lon)."""
    n = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(
        n.cast("long").alias("place_key"),
        F.col("n_name").alias("name"),
        F.substring("n_name", 1, 2).alias("cc"),
        (((n * PLACE_LAT_STEP) % PLACE_LAT_MOD - 8000) / 100.0).alias("lat"),
        (((n * PLACE_LON_STEP) % PLACE_LON_MOD - 18000) / 100.0).alias("lon"),
    )
