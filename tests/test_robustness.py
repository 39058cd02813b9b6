import threading

import pytest

from meteocube.operators.hourly import with_station_key
from meteocube.plans import catalog
from meteocube.plans.build import build
from meteocube.sinks.parquet import write_table
from meteocube.streaming import start_hourly_ingest

from helpers import raw_df

PLACES = [(1, "Irvine", "US", 33.68, -117.82)]


def test_rebuild_into_same_root_is_idempotent(spark, tmp_dir):
    rows = [(f"2020-01-0{d} {h:02d}:00", 33.68, -117.87, float(d + h), 1.0, 1.0, 1.0) for d in (1, 2) for h in (0, 6)]
    places = spark.createDataFrame(PLACES, "place_key long, name string, cc string, lat double, lon double")
    tables = ("hourly", "daily", "monthly", "yearly", "locations")
    first = build(spark, raw_df(spark, rows), places, f"{tmp_dir}/cube")
    before = {t: sorted(map(tuple, first.table(t).collect())) for t in tables}
    # e.g. a re-run after a failure: a new version; the earlier handle keeps its own
    second = build(spark, raw_df(spark, rows), places, f"{tmp_dir}/cube")
    assert {t: sorted(map(tuple, second.table(t).collect())) for t in tables} == before
    assert second.hourly().count() == len(rows)


def test_concurrent_callers_share_one_cube(spark):
    roots = []
    threads = [threading.Thread(target=lambda: roots.append(catalog.cube(spark, "/root/testdata/sf0.001").root))
               for _ in range(3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(roots) == 3 and len(set(roots)) == 1


def test_bad_options_raise(spark, tmp_dir):
    df = raw_df(spark, [("2020-01-01 00:00", 33.68, -117.87, 1.0, 1.0, 1.0, 1.0)])
    with pytest.raises(ValueError, match="layout"):
        write_table(df, f"{tmp_dir}/x", layout="zorder")
    with pytest.raises(ValueError, match="id_mode"):
        with_station_key(df, "grid")
    with pytest.raises(ValueError, match="fmt"):
        start_hourly_ingest(spark, tmp_dir, f"{tmp_dir}/y", fmt="json")
