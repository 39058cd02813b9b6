"""meteocube: station-measurement rollup cube on Spark DataFrames.

Raw readings -> hourly fact + location dimension -> daily -> monthly, yearly;
snapshot and series range queries over the stored tables.  Everything takes
and returns DataFrames; importing the package starts no session.
"""

from .operators.hourly import hourly_fact, split_rejects
from .operators.locations import location_dimension, nearest_place, station_cells
from .operators.rollup import daily_rollup, daily_rollup_join_form, monthly_rollup, yearly_rollup
from .plans.build import Cube, build, ingest_csv, open_cube
from .plans.dispatch import answer, check_request, query
from .plans.queries import series, snapshot, station_listing

__all__ = [
    "Cube", "answer", "build", "check_request", "ingest_csv", "daily_rollup", "daily_rollup_join_form", "hourly_fact",
    "location_dimension", "monthly_rollup", "nearest_place", "open_cube", "query", "series", "snapshot",
    "split_rejects", "station_cells", "station_listing", "yearly_rollup",
]
