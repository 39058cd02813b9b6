import glob

import pytest
from pyspark.sql import functions as F

from meteocube.operators.guard import check_result, guard_status, preview, value_range
from meteocube.plans.build import build
from meteocube.plans.dispatch import check_request, query
from meteocube.plans.queries import series, snapshot, station_listing
from meteocube.sources.raw import read_csv

from helpers import plan_text, raw_df

PLACES = [(1, "Irvine", "US", 33.68, -117.82), (2, "Sydney", "AU", -33.87, 151.21)]


@pytest.fixture(scope="module")
def cube(spark):
    import tempfile

    rows = []
    for d in range(1, 29):
        for h in (0, 12, 23):
            rows.append((f"2020-01-{d:02d} {h:02d}:00", 33.68, -117.87, float(d), float(h), 1.0, 1000.0))
            rows.append((f"2020-02-{d:02d} {h:02d}:00", 33.21, -117.87, float(-d), float(h), 2.0, 1001.0))
            rows.append((f"2021-03-{d:02d} {h:02d}:00", -33.95, 151.18, float(d) / 2, 1.0, 3.0, 999.0))
    raw = raw_df(spark, rows)
    places = spark.createDataFrame(PLACES, "place_key long, name string, cc string, lat double, lon double")
    return build(spark, raw, places, tempfile.mkdtemp(prefix="meteocube-cube-"))


def test_location_dimension_one_row_per_id(cube):
    loc = {r.id: r for r in cube.locations().collect()}
    assert set(loc) == {"12300-6213", "5600-33118"}
    a = loc["12300-6213"]
    assert (a.LATITUDE, a.n_points, a.city) == (33.21, 2, "Irvine, US")   # smallest latitude represents
    assert loc["5600-33118"].city == "Sydney, AU"


def test_snapshot_daily_left_join_never_multiplies(cube):
    df = snapshot(cube.daily(), cube.locations(), "daily", "TMP", "avg", "2020-01-30", "2020-02-02")
    rows = df.collect()
    assert [str(r.DATE) for r in rows] == ["2020-02-01", "2020-02-02"]
    assert rows[0].city == "Irvine, US" and rows[0].avgTMP == -1.0
    assert df.columns == ["DATE", "id", "avgTMP", "city", "LATITUDE", "LONGITUDE"]


def test_snapshot_broadcasts_checked_dimension(cube):
    df = snapshot(cube.daily(), cube.locations(), "daily", "TMP", "avg", "2020-01-30", "2020-02-02")
    assert "BroadcastHashJoin" in plan_text(df, "simple")


def test_series_levels(cube):
    h = series(cube.hourly(), "hourly", "TMP", "", "2020-01-05", "2020-01-05", "12300-6213").collect()
    assert [r.TMP for r in h] == [5.0, 5.0, 5.0]
    m = series(cube.monthly(), "monthly", "TMP", "avg_max", "2020-01-01", "2020-12-31", "12300-6213").collect()
    assert [(r.year_month, r.label) for r in m] == [(202001, "2020 Jan"), (202002, "2020 Feb")]
    y = series(cube.yearly(), "yearly", "SLP", "max", "2019-01-01", "2022-01-01", "5600-33118").collect()
    assert [(r.year, r.maxSLP) for r in y] == [(2021, 999.0)]


def test_series_pushes_id_and_prunes(cube):
    df = series(cube.daily(), "daily", "TMP", "avg", "2020-01-01", "2020-01-10", "12300-6213")
    plan = plan_text(df)
    assert "EqualTo(id,12300-6213)" in plan
    assert "PartitionFilters: [isnotnull(year" in plan


def test_station_listing_sorted(cube):
    assert [r.id for r in station_listing(cube.points()).collect()] == ["12300-6213", "12300-6213", "5600-33118"]


@pytest.mark.parametrize("args,msg", [
    (("daily", "TMP", "avg", "2020-02-01", "2020-01-01"), "invalid date"),
    (("", "TMP", "avg", "2020-01-01", "2020-01-02"), "level"),
    (("daily", "TMP", "", "2020-01-01", "2020-01-02"), "aggregation"),
    (("daily", "TMP", "avg_min", "2020-01-01", "2020-01-02"), "not allowed"),
    (("daily", "TMP", "avg", "2020-01-01", "2020-03-01"), "31 days"),
    (("hourly", "TMP", "", "2020-01-01", "2020-01-05"), "2 days"),
    (("monthly", "RAIN", "avg", "2020-01-01", "2020-01-05"), "metric"),
])
def test_request_rules(args, msg):
    with pytest.raises(ValueError, match=msg):
        check_request(*args)


def test_request_rules_allow_series_spans():
    check_request("hourly", "TMP", "", "2020-01-01", "2020-01-30", "12300-6213")
    check_request("daily", "TMP", "avg", "2014-01-01", "2023-12-31", "12300-6213")
    with pytest.raises(ValueError, match="31 days"):
        check_request("hourly", "TMP", "", "2020-01-01", "2020-03-01", "12300-6213")


def test_dispatch_picks_series_or_snapshot(cube):
    s = query(cube, "yearly", "TMP", "avg", "2020-01-01", "2021-12-31", " 12300-6213 ")
    assert s.columns == ["year", "avgTMP"]
    m = query(cube, "yearly", "TMP", "avg", "2020-01-01", "2021-12-31")
    assert m.count() == 2 and "city" in m.columns


def test_guard_and_range(cube):
    df = snapshot(cube.daily(), cube.locations(), "daily", "TMP", "avg", "2020-01-01", "2020-01-31")
    assert check_result(df) == "ok"
    assert check_result(df.filter(F.lit(False))) == "No Data"
    assert check_result(df, cap=10) == "Too Large"
    assert [tuple(r) for r in guard_status(df, cap=10).collect()] == [(28, "Too Large")]
    r = value_range(df, "avgTMP").first()
    assert (r.range_min, r.range_max) == (1.0, 28.0)
    assert preview(cube.yearly(), ["id", "year"], 1).count() == 1


def test_sql_views(spark, cube):
    names = cube.register_views()
    n = spark.sql(f"SELECT count(*) AS n FROM {names['daily']} d JOIN {names['locations']} l USING (id)").first().n
    assert n == 28 * 3


def test_clustered_layout_one_file_per_directory(cube):
    files = glob.glob(f"{cube.root}/daily/year=*/month=*/*.parquet")
    dirs = {f.rsplit("/", 1)[0] for f in files}
    assert len(dirs) == 3 and len(files) == 3


def test_csv_bad_text_becomes_null_and_rejected(spark, tmp_dir):
    path = f"{tmp_dir}/raw.csv"
    with open(path, "w") as f:
        f.write("DATE,LONGITUDE,LATITUDE,TMP,DEW,WND_RATE,SLP,MASK,TIME_DIFF\n")
        f.write("2020-01-01 00:00:00,-117.87,33.68,1.5,abc,2,1000,x,0\n")
        f.write("2020-01-01 01:00:00,,33.68,1.5,1,2,1000,x,0\n")
        f.write("2020-01-01 02:00:00,abc,33.68,1.5,1,2,1000,x,0\n")
    df = read_csv(spark, path)
    rows = df.orderBy("DATE").collect()
    assert rows[0].DEW is None and rows[0].TMP == 1.5 and rows[0].MASK == "x"
    from meteocube.operators.hourly import split_rejects
    ok, bad = split_rejects(df)
    assert (ok.count(), bad.count()) == (1, 2)


def test_answer_counts_unsorted_and_returns_sorted(cube):
    from meteocube.plans.dispatch import answer

    status, pdf = answer(cube, "daily", "TMP", "avg", "2020-01-01", "2020-01-05")
    assert status == "ok" and list(pdf["DATE"].astype(str)) == [f"2020-01-0{d}" for d in range(1, 6)]
    assert answer(cube, "daily", "TMP", "avg", "2020-01-01", "2020-01-05", cap=2) == ("Too Large", None)
    assert answer(cube, "yearly", "TMP", "avg", "2030-01-01", "2031-01-05") == ("No Data", None)


def test_guard_plan_has_no_top_k(cube):
    df = snapshot(cube.daily(), cube.locations(), "daily", "TMP", "avg", "2020-01-01", "2020-01-31", ordered=False)
    plan = plan_text(guard_status(df), "simple")
    assert "TakeOrdered" not in plan and "Sort [" not in plan


def test_hourly_ignores_agg(cube):
    check_request("hourly", "TMP", "avg", "2020-01-01", "2020-01-02")
    df = query(cube, "hourly", "TMP", "max", "2020-01-05", "2020-01-05", "12300-6213")
    assert df.columns == ["DATE", "TMP"]


def test_hourly_files_sorted_by_day_then_station(cube):
    import pyarrow.parquet as pq

    files = glob.glob(f"{cube.root}/hourly/year=*/month=*/*.parquet")
    assert files
    for f in files:
        t = pq.read_table(f, columns=["DATE", "id"]).to_pylist()
        keys = [(r["DATE"].date(), r["id"], r["DATE"]) for r in t]
        assert keys == sorted(keys)


def test_hourly_values_rounded_in_snapshot_and_series(spark):
    # Both hourly forms return the measure rounded to 2 places
    from meteocube.operators.hourly import hourly_fact

    hourly = hourly_fact(raw_df(spark, [("2020-01-01 05:00", 33.68, -117.87, 1.236, 1.0, 1.0, -2.345)]))
    locs = spark.createDataFrame([("12300-6213", "X, YY", 33.68, -117.87)], "id string, city string, LATITUDE double, LONGITUDE double")
    s = series(hourly, "hourly", "TMP", "", "2020-01-01", "2020-01-01", "12300-6213").first()
    m = snapshot(hourly, locs, "hourly", "SLP", "", "2020-01-01", "2020-01-01").first()
    assert (s.TMP, m.SLP, m.city) == (1.24, -2.35, "X, YY")


def test_build_writes_rejects(spark, tmp_dir):
    rows = [("2020-01-01 00:00", 33.68, -117.87, 1.0, 1.0, 1.0, 1.0), ("2020-01-01 01:00", None, -117.87, 2.0, 1.0, 1.0, 1.0)]
    places = spark.createDataFrame(PLACES, "place_key long, name string, cc string, lat double, lon double")
    c = build(spark, raw_df(spark, rows), places, f"{tmp_dir}/cube")
    assert [r.TMP for r in c.rejects().collect()] == [2.0]
    assert c.hourly().count() == 1


def test_cube_rejects_empty_when_clean(cube):
    assert cube.rejects().count() == 0


def test_build_with_station_keys_separates_colliding_stations(spark, tmp_dir):
    # The two stations share the published cell id but get their own station ids
    rows = [("2020-01-01 00:00", 33.68, -117.87, 1.0, 1.0, 1.0, 1.0), ("2020-01-01 00:00", 33.21, -117.87, 3.0, 1.0, 1.0, 1.0)]
    places = spark.createDataFrame(PLACES, "place_key long, name string, cc string, lat double, lon double")
    cell = build(spark, raw_df(spark, rows), places, f"{tmp_dir}/cell")
    st = build(spark, raw_df(spark, rows), places, f"{tmp_dir}/station", id_mode="station")
    assert [(r.id, r.avgTMP) for r in cell.daily().collect()] == [("12300-6213", 2.0)]
    assert sorted((r.id, r.avgTMP) for r in st.daily().collect()) == [("12321-6213", 3.0), ("12368-6213", 1.0)]
    assert sorted(r.n_points for r in st.locations().collect()) == [1, 1]
