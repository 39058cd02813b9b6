"""Schemas, allowed request values and fixed constants of the cube.

Everything here is data, not logic: the published grain and column names,
the request vocabulary and the default limits of the public front.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values (must match the published table layout and request rules) ---
METRICS = ("TMP", "DEW", "WIND", "SLP")
RAW_WIND = "WND_RATE"  # raw name of the WIND measure
LEVELS = ("hourly", "daily", "monthly", "yearly")
TABLES = ("hourly", "daily", "monthly", "yearly", "locations")  # table folder names
VIEW_NAMES = {"hourly": "hourly_view", "daily": "daily_view", "monthly": "monthly_view",
              "yearly": "yearly_view", "locations": "location_table"}
DAILY_AGGS = ("avg", "min", "max")
PERIOD_AGGS = ("avg", "avg_min", "min", "avg_max", "max")
ALLOWED_AGGS = {
    "hourly": ("",),
    "daily": DAILY_AGGS,
    "monthly": PERIOD_AGGS,
    "yearly": PERIOD_AGGS,
}
ROW_LIMIT = 380_000          # largest answer that the front hands to a caller, unless told otherwise
LIMITS = {                   # most days between start and end that the front accepts, unless told otherwise
    "daily_snapshot": 31,
    "hourly_snapshot": 2,
    "hourly_series": 31,
}
EARTH_RADIUS_KM = 6371.0
# --- end of fixed values ---

KEY_COLUMNS = ("DATE", "LATITUDE", "LONGITUDE")

RAW_SCHEMA = T.StructType(
    [
        T.StructField("DATE", T.TimestampNTZType()),
        T.StructField("LATITUDE", T.DoubleType()),
        T.StructField("LONGITUDE", T.DoubleType()),
        T.StructField("TMP", T.DoubleType()),
        T.StructField("DEW", T.DoubleType()),
        T.StructField(RAW_WIND, T.DoubleType()),
        T.StructField("SLP", T.DoubleType()),
    ]
)


_TYPES = {"string": T.StringType(), "double": T.DoubleType(), "int": T.IntegerType(), "long": T.LongType(),
          "date": T.DateType(), "timestamp_ntz": T.TimestampNTZType()}


def _ddl(*columns: str) -> T.StructType:
    return T.StructType([T.StructField(c.split()[0], _TYPES[c.split()[1]]) for c in columns])


_PERIOD = [f"{a}{m} double" for m in METRICS for a in PERIOD_AGGS]

#: Stored tables as they are read when a build had no rows for them (their folders then hold no file).
#: ``hourly`` keeps the coordinates beside the id, and holds the rejects under a null year and month.
STORED = {
    "hourly": _ddl("DATE timestamp_ntz", "LATITUDE double", "LONGITUDE double", *[f"{m} double" for m in METRICS], "id string", "year int", "month int"),
    "points": _ddl("LATITUDE double", "LONGITUDE double", "city string", "id string"),
    "locations": _ddl("LATITUDE double", "LONGITUDE double", "city string", "id string", "n_points long"),
    "daily": _ddl("id string", "DATE date", *[f"{a}{m} double" for m in METRICS for a in DAILY_AGGS], "year int", "month int"),
    "monthly": _ddl("id string", *_PERIOD, "year int", "month int"),
    "yearly": _ddl("id string", "year int", *_PERIOD),
}
