"""Hourly fact and reject split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.cell import cell_id, round_coord, station_id
from ..schema import KEY_COLUMNS, RAW_WIND


def valid_coordinates(lat: str = "LATITUDE", lon: str = "LONGITUDE") -> F.Column:
    """Both coordinates present, finite and on the globe (NaN sorts above every number in Spark)."""
    return F.col(lat).between(-90.0, 90.0) & F.col(lon).between(-180.0, 180.0)


def _key_ok() -> F.Column:
    ok = F.lit(True)
    for c in KEY_COLUMNS:
        ok = ok & F.col(c).isNotNull()
    return ok & valid_coordinates()


def split_rejects(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with a time and valid coordinates, the others).

    A reading without a time, or with a missing, non-finite or off-globe
    coordinate, is a reject: it can form no key and must not fail the job.
    """
    ok = F.coalesce(_key_ok(), F.lit(False))
    return raw.filter(ok), raw.filter(~ok)


def _key_function(id_mode: str):
    if id_mode not in ("cell", "station"):
        raise ValueError(f"id_mode must be 'cell' or 'station', got {id_mode!r}")
    return cell_id if id_mode == "cell" else station_id


def with_station_key(raw: DataFrame, id_mode: str = "cell") -> DataFrame:
    """Round coordinates to 0.01 degree and add the station key ``id``."""
    key = _key_function(id_mode)
    df = raw.withColumns({"LONGITUDE": round_coord("LONGITUDE"), "LATITUDE": round_coord("LATITUDE")})
    return df.withColumn("id", key("LATITUDE", "LONGITUDE"))


def stored_hourly(raw: DataFrame, id_mode: str = "cell") -> DataFrame:
    """Raw readings as the hourly table stores them: every reading, in one pass over the input.

    Valid readings get ``id``, ``year``, ``month`` and rounded coordinates; rejects keep theirs as read under a
    null ``id``, ``year`` and ``month``, which is a partition of its own that no query of the fact opens.
    """
    key = _key_function(id_mode)
    ok = F.coalesce(_key_ok(), F.lit(False))
    df = raw.withColumnRenamed(RAW_WIND, "WIND") if RAW_WIND in raw.columns else raw
    lat, lon = round_coord("LATITUDE"), round_coord("LONGITUDE")
    return df.withColumns({
        "LATITUDE": F.when(ok, lat).otherwise(F.col("LATITUDE")),
        "LONGITUDE": F.when(ok, lon).otherwise(F.col("LONGITUDE")),
        "id": F.when(ok, key(lat, lon)),
        "year": F.when(ok, F.year("DATE")),
        "month": F.when(ok, F.month("DATE")),
    })


def fact_of(stored: DataFrame) -> DataFrame:
    """The hourly fact of a stored table: valid readings without coordinates (a pruned partition and columns)."""
    return stored.filter(F.col("year").isNotNull()).drop("LONGITUDE", "LATITUDE")


def rejects_of(stored: DataFrame) -> DataFrame:
    """The rejects of a stored table, as read (one partition)."""
    return stored.filter(F.col("year").isNull()).drop("id", "year", "month")


def cells_of(stored: DataFrame) -> DataFrame:
    """Distinct (id, LONGITUDE, LATITUDE) of a stored table: three columns, not the raw readings."""
    return stored.filter(F.col("year").isNotNull()).select("id", "LONGITUDE", "LATITUDE").distinct()


def hourly_fact(raw: DataFrame, id_mode: str = "cell") -> DataFrame:
    """Raw readings -> hourly fact: no coordinates, ``id``, ``year``, ``month``.

    Readings without a time or a coordinate are left out (see ``split_rejects``);
    every other raw column passes through, WND_RATE renamed to WIND.
    """
    valid, _ = split_rejects(raw)
    df = with_station_key(valid, id_mode)
    if RAW_WIND in df.columns:
        df = df.withColumnRenamed(RAW_WIND, "WIND")
    df = df.withColumns({"year": F.year("DATE"), "month": F.month("DATE")})
    return df.drop("LONGITUDE", "LATITUDE")
