"""The whole build (Q11) and the handle on its stored tables.

raw -> hourly (one pass: the fact partitioned by year and month, rejects in a
partition of their own) -> daily -> exact sums per month -> monthly and yearly; and hourly -> distinct
coordinates -> points (every coordinate with its city) -> locations (one row
per station key).  Every stage continues from what an earlier stage wrote (K6),
so a failure re-runs one stage, not the lineage from the raw scan, and each
stage's plan starts from a parquet scan with pruning and pushdown.  Independent
work is submitted as concurrent Spark jobs.

A build writes to a new version folder below the root and appends a row to the
root's ``_published`` table only when all its tables are complete: readers keep
the version they opened, and a failed build leaves the published one as it was.
"""

from __future__ import annotations

import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.hourly import cells_of, fact_of, rejects_of, stored_hourly
from ..operators.joins import MAX_BROADCAST_ROWS, bounded_rows
from ..operators.locations import BASE_CELL_DEG, locate, one_per_station
from ..operators.rollup import daily_rollup, monthly_of, monthly_sums, yearly_of
from ..schema import STORED, TABLES, VIEW_NAMES
from ..sinks.parquet import materialize, write_sorted, write_table
from ..sources.raw import read_csv_text, register_views, typed_with_bad_text

_PUBLISHED = "version string, at long"


def hourly_order() -> tuple:
    """Order inside each hourly file: day, then station, then time (see sinks.parquet)."""
    return (F.to_date("DATE"), "id", "DATE")


def hourly_spread() -> dict:
    """Hourly files are dealt by day inside their month."""
    return {"_day": F.to_date("DATE")}


@dataclass(frozen=True)
class Cube:
    """Stored cube tables of one version (``root`` is the version's folder).

    The tables are immutable once built, so each is opened once per handle
    (one schema read), and the DataFrame is reused by every query.
    """

    spark: SparkSession
    root: str
    _frames: dict = field(default_factory=dict, repr=False, compare=False)

    def _stored(self, name: str) -> DataFrame:
        if name not in self._frames:
            try:
                df = self.spark.read.parquet(f"{self.root}/{name}")
            except AnalysisException as e:  # a table without rows has no file to take the schema from
                if "UNABLE_TO_INFER_SCHEMA" not in str(e):
                    raise
                df = self.spark.read.schema(STORED[name]).parquet(f"{self.root}/{name}")
            if name == "hourly":  # with rejects alone, partition discovery finds no number to type the columns by
                df = df.withColumns({c: F.col(c).cast("int") for c in ("year", "month") if df.schema[c].dataType.typeName() != "integer"})
            self._frames[name] = df
        return self._frames[name]

    def table(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise ValueError(f"unknown table {name!r}; one of {TABLES}")
        return fact_of(self._stored(name)) if name == "hourly" else self._stored(name)

    def hourly(self) -> DataFrame:
        return self.table("hourly")

    def daily(self) -> DataFrame:
        return self.table("daily")

    def monthly(self) -> DataFrame:
        return self.table("monthly")

    def yearly(self) -> DataFrame:
        return self.table("yearly")

    def locations(self) -> DataFrame:
        """One row per station key: the dimension that snapshots join."""
        return self.table("locations")

    def points(self) -> DataFrame:
        """Every distinct coordinate with its city and station key: the station listing."""
        return self._stored("points")

    def rejects(self) -> DataFrame:
        """Raw readings left out of the fact (no time or no valid coordinate), as read."""
        return rejects_of(self._stored("hourly"))

    @cached_property
    def location_rows(self) -> int:
        """Row count of the stored dimension (bounded at the broadcast limit + 1), measured once."""
        return bounded_rows(self.locations(), MAX_BROADCAST_ROWS)

    def register_views(self) -> dict[str, str]:
        """The five tables as temp views for ``spark.sql``."""
        register_views({VIEW_NAMES[t]: self.table(t) for t in TABLES})
        return dict(VIEW_NAMES)


def ingest_csv(spark: SparkSession, csv_dir: str, parquet_dir: str) -> DataFrame:
    """Stage 1: header CSV (read as text, typed with try_cast) -> parquet; returns the written table.

    The rebalance lets AQE size the output files independently of how the CSV files were cut.  Beside it,
    ``<parquet_dir>_bad_text`` counts per column the texts that are not empty and did not parse.  The text is read once:
    the counts are observed in the stage that writes, whose tasks count once each however often a scan is repeated.
    """
    rows, columns, seen = observed_csv(spark, csv_dir)
    write_table(rows, parquet_dir, (), "small_files")
    found = seen.get if columns else {}
    bad = spark.createDataFrame([(c, int(found.get(f"n{k}") or 0)) for k, c in enumerate(columns)], "column_name string, n_bad long")
    write_table(bad.coalesce(1), f"{parquet_dir.rstrip('/')}_bad_text", (), "small_files")
    return spark.read.parquet(parquet_dir)


def observed_csv(spark: SparkSession, csv_dir: str) -> tuple[DataFrame, list[str], Observation]:
    """Typed rows of a header CSV, rebalanced for a write; the typed columns; their counts of bad texts (``n0``, ``n1``, ...) once written."""
    typed, masks, counts = typed_with_bad_text(read_csv_text(spark, csv_dir))
    rows, seen = typed.hint("rebalance"), Observation()
    if counts:
        rows = rows.observe(seen, *[n.alias(f"n{k}") for k, n in enumerate(counts.values())])
    return rows.drop(*masks), list(counts), seen


def build(spark: SparkSession, raw: DataFrame, places: DataFrame, root: str, layout: str = "clustered",
          id_mode: str = "cell", base_cell_deg: float | None = BASE_CELL_DEG, row_group_bytes: int | None = None) -> Cube:
    """Q11: write the cube tables as a new version under ``root``, publish it; return the handle.

    ``row_group_bytes``: size of the row groups of the hourly table (smaller: a series reads less beside its station).
    """
    root = root.rstrip("/")
    version = f"v-{uuid.uuid4().hex[:12]}"
    to = f"{root}/{version}"
    stored = materialize(spark, stored_hourly(raw, id_mode), f"{to}/hourly", ("year", "month"), layout, hourly_order(), hourly_spread(), row_group_bytes)

    def place_stations() -> None:
        points = locate(cells_of(stored), places, base_cell_deg)
        write_sorted(points, f"{to}/points", ("id", "LATITUDE", "LONGITUDE"))
        points = spark.read.schema(points.schema).parquet(f"{to}/points")
        write_sorted(one_per_station(points), f"{to}/locations", ("id",))

    with ThreadPoolExecutor(max_workers=3) as pool:
        placed = pool.submit(place_stations)  # beside the rollup chain
        daily = materialize(spark, daily_rollup(fact_of(stored)), f"{to}/daily", ("year", "month"), layout, ("id", "DATE"))
        # Both period tables from one pass over the days.
        sums = materialize(spark, monthly_sums(daily, gathered=layout == "clustered"), f"{to}/_monthly_sums", (), "small_files")
        _all(
            pool.submit(write_table, monthly_of(sums), f"{to}/monthly", ("year", "month"), layout, ("id",)),
            # Unpartitioned: the rebalance lets AQE size the files (one file while the table is small).
            pool.submit(write_table, yearly_of(sums), f"{to}/yearly", (), layout, ("id", "year")),
            placed,
        )
    row = spark.createDataFrame([(version, time.time_ns())], _PUBLISHED)
    row.coalesce(1).write.mode("append").parquet(f"{root}/_published")
    return Cube(spark, to)


def open_cube(spark: SparkSession, root: str) -> Cube:
    """The version under ``root`` that was published last."""
    root = root.rstrip("/")
    last = spark.read.schema(_PUBLISHED).parquet(f"{root}/_published").orderBy(F.desc("at")).first()
    return Cube(spark, f"{root}/{last.version}")


def _all(*futures) -> None:
    for f in futures:
        f.result()
