"""Builds of odd inputs, published versions, and what a query opens of the hourly table."""

import glob
import os

import pyarrow.parquet as pq
import pytest

from meteocube.operators import locations
from meteocube.plans.build import Cube, build, open_cube
from meteocube.plans.dispatch import answer, check_request, query
from meteocube.plans.queries import series, snapshot, station_listing
from meteocube.session import shared_dir
from meteocube.sinks.parquet import write_table

from helpers import raw_df

ST = (33.68, -117.87)
PLACES = [(1, "Irvine", "US", 33.68, -117.82), (2, "Sydney", "AU", -33.87, 151.21)]


def places_df(spark, rows=PLACES):
    return spark.createDataFrame(rows, "place_key long, name string, cc string, lat double, lon double")


ALL = ("hourly", "daily", "monthly", "yearly", "locations", "points")


def read(cube, name):
    return cube.points() if name == "points" else cube.table(name)


@pytest.mark.parametrize("layout", ["clustered", "small_files"])
def test_empty_input_builds_empty_tables(spark, tmp_dir, layout):
    build(spark, raw_df(spark, []), places_df(spark), f"{tmp_dir}/cube", layout)
    c = open_cube(spark, f"{tmp_dir}/cube")
    assert {t: read(c, t).count() for t in ALL} == dict.fromkeys(ALL, 0) and c.rejects().count() == 0
    assert answer(c, "daily", "TMP", "avg", "2020-01-01", "2020-01-02") == ("No Data", None)


def test_input_of_rejects_alone_builds(spark, tmp_dir):
    rows = [(None, *ST, 1.0, 1.0, 1.0, 1.0), ("2020-01-01 00:00", None, 1.0, 2.0, 1.0, 1.0, 1.0), ("2020-01-01 00:00", float("nan"), 1.0, 3.0, 1.0, 1.0, 1.0)]
    c = build(spark, raw_df(spark, rows), places_df(spark), f"{tmp_dir}/cube")
    for handle in (c, open_cube(spark, f"{tmp_dir}/cube")):
        assert {t: read(handle, t).count() for t in ALL} == dict.fromkeys(ALL, 0)
        assert sorted(r.TMP for r in handle.rejects().collect()) == [1.0, 2.0, 3.0]
    assert c.rejects().columns == ["DATE", "LATITUDE", "LONGITUDE", "TMP", "DEW", "WIND", "SLP"]


def test_a_new_version_is_published_last_and_old_readers_keep_theirs(spark, tmp_dir):
    root = f"{tmp_dir}/cube"
    first = build(spark, raw_df(spark, [("2020-01-01 00:00", *ST, 1.0, 1.0, 1.0, 1.0)]), places_df(spark), root)
    broken = raw_df(spark, [("2020-01-01 00:00", *ST, 1e22, 1.0, 1.0, 1.0)])
    with pytest.raises(Exception):
        build(spark, broken, places_df(spark), root)
    assert open_cube(spark, root).root == first.root
    second = build(spark, raw_df(spark, [("2020-01-01 00:00", *ST, 5.0, 1.0, 1.0, 1.0)]), places_df(spark), root)
    assert open_cube(spark, root).root == second.root != first.root
    assert [Cube(spark, c.root).daily().first().avgTMP for c in (first, second)] == [1.0, 5.0]


def test_listing_has_every_coordinate(spark, tmp_dir):
    rows = [("2020-01-01 00:00", lat, -117.87, 1.0, 1.0, 1.0, 1.0) for lat in (33.68, 33.21, 33.21)]
    c = build(spark, raw_df(spark, rows), places_df(spark), f"{tmp_dir}/cube")
    got = [tuple(r) for r in station_listing(c.points()).collect()]
    assert got == [("Irvine, US", "12300-6213", 33.21, -117.87), ("Irvine, US", "12300-6213", 33.68, -117.87)]
    assert [r.n_points for r in c.locations().collect()] == [2]


def test_raw_readings_are_scanned_once(spark, tmp_dir):
    """Every later stage starts from what the first one wrote."""
    src = f"{tmp_dir}/raw"
    raw_df(spark, [("2020-01-01 00:00", *ST, 1.0, 1.0, 1.0, 1.0)]).write.parquet(src)
    c = build(spark, spark.read.parquet(src), places_df(spark), f"{tmp_dir}/cube")
    os.rename(src, f"{src}-away")
    assert c.rejects().count() == 0 and c.points().count() == 1 and c.hourly().count() == 1


def many_files(spark, tmp_dir):
    """A month of 28 days and 40 stations whose raw rows come in no order, in many files of at most a few days."""
    rows = [(f"2020-01-{d:02d} {h:02d}:00", 10.0 + s, 20.0, float(s), 1.0, 1.0, 1.0) for h in (0, 12) for s in range(40) for d in range(1, 29)]
    # A full partition for each hash of a day, as at scale: nothing to split, nothing to merge.
    off = ("spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled", "spark.sql.adaptive.coalescePartitions.enabled")
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", *off)}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "200")
        for k in off:
            spark.conf.set(k, "false")
        return build(spark, raw_df(spark, rows).repartition(6), places_df(spark), f"{tmp_dir}/cube")
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_hourly_files_hold_disjoint_days_and_queries_open_few(spark, tmp_dir):
    c = many_files(spark, tmp_dir)
    files = glob.glob(f"{c.root}/hourly/year=2020/month=1/*.parquet")
    days = {f: {x["DATE"].day for x in pq.read_table(f, columns=["DATE"]).to_pylist()} for f in files}
    assert len(files) >= 20
    holders = {d: [f for f, held in days.items() if d in held] for d in range(1, 29)}
    assert all(len(v) == 1 for v in holders.values())  # a day is in one file
    bounds = {f: (min(v), max(v)) for f, v in days.items()}
    for d in (1, 14, 28):  # files whose statistics let them hold the day: what a one-day snapshot has to read
        assert sum(lo <= d <= hi for lo, hi in bounds.values()) <= len(files) // 3
    for f in files:  # inside a file: by day, then station, so a station's rows of a day are one range
        keys = [(x["DATE"].date(), x["id"], x["DATE"]) for x in pq.read_table(f, columns=["DATE", "id"]).to_pylist()]
        assert keys == sorted(keys)
    got = series(c.hourly(), "hourly", "TMP", "", "2020-01-05", "2020-01-05", "10300-20000").collect()
    assert [r.TMP for r in got] == [3.0, 3.0]
    assert snapshot(c.hourly(), c.locations(), "hourly", "TMP", "", "2020-01-05", "2020-01-05").count() == 80


def scanned_rows(df):
    """Rows that the parquet scan of a query handed on: those of the row groups and pages it opened."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if plan.nodeName().startswith("AdaptiveSparkPlan") else plan
    found, todo = 0, [plan]
    while todo:
        node = todo.pop()
        if hasattr(node, "plan") and "QueryStage" in node.getClass().getSimpleName():
            todo.append(node.plan())
        if node.nodeName().startswith("Scan parquet"):
            found += node.metrics().apply("numOutputRows").value()
        todo += [node.children().apply(k) for k in range(node.children().size())]
    return found


def test_a_series_skips_row_groups_of_other_stations(spark, tmp_dir):
    rows = [(f"2020-01-{d:02d} {h:02d}:00", 10.0 + s, 20.0, float(s), 1.0, 1.0, 1.0) for h in range(24) for s in range(40) for d in range(1, 8)]
    raw, read_rows, groups, answers = raw_df(spark, rows).repartition(3), {}, {}, []
    for layout in ("clustered", "small_files"):
        c = build(spark, raw, places_df(spark), f"{tmp_dir}/{layout}", layout, row_group_bytes=4096)
        files = glob.glob(f"{c.root}/hourly/year=2020/month=1/*.parquet")
        ranges = []
        for f in files:
            meta = pq.ParquetFile(f).metadata
            at = meta.schema.names.index("id")
            ranges += [meta.row_group(k).column(at).statistics for k in range(meta.num_row_groups)]
        groups[layout] = (sum(s.min <= "12500-20000" <= s.max for s in ranges), len(ranges))
        df = series(c.hourly(), "hourly", "TMP", "", "2020-01-01", "2020-01-07", "12500-20000")
        read_rows[layout] = scanned_rows(df)
        answers.append(df.collect())
    assert answers[0] == answers[1] and len(answers[0]) == 7 * 24
    hit, total = groups["clustered"]
    assert total >= 20 and hit <= total / 2, groups
    assert groups["small_files"][0] == groups["small_files"][1]  # every group may hold the station
    assert hit < groups["small_files"][0] and 7 * 24 <= read_rows["clustered"] < read_rows["small_files"], (groups, read_rows)


def test_answers_are_sorted_in_all_eight_forms(spark, tmp_dir):
    c = many_files(spark, tmp_dir)
    for level, agg, time in (("hourly", "", "DATE"), ("daily", "avg", "DATE"), ("monthly", "avg", "year_month"), ("yearly", "avg", "year")):
        args = (level, "TMP", agg, "2020-01-01", "2020-01-28")
        snap = [(r[time], r.id) for r in query(c, *args, limits=None).collect()]
        assert len(snap) >= 40 and snap == sorted(snap)
        one = [r[time] for r in query(c, *args, "10300-20000", limits=None).collect()]
        assert one == sorted(one)
        status, pdf = answer(c, *args, limits=None)
        assert status == "ok" and list(zip(pdf[time], pdf["id"])) == snap


def test_limits_are_the_callers_choice(spark, tmp_dir):
    c = many_files(spark, tmp_dir)
    args = ("daily", "TMP", "avg", "2019-06-01", "2020-12-31")
    with pytest.raises(ValueError, match="31 days"):
        query(c, *args)
    with pytest.raises(ValueError, match="3 days"):
        check_request("hourly", "TMP", "", "2020-01-01", "2020-01-09", limits={"hourly_snapshot": 3})
    assert query(c, *args, limits=None).count() == 28 * 40
    assert answer(c, *args, cap=28 * 40, limits=None)[0] == "ok" and answer(c, *args, cap=28 * 40 - 1, limits=None) == ("Too Large", None)
    status, df = answer(c, *args, cap=None, limits=None)
    assert status == "ok" and df.count() == 28 * 40


def test_single_file_means_one_file(spark, tmp_dir):
    write_table(spark.range(0, 5000, 1, 8), f"{tmp_dir}/one", layout="single_file", sort_by=("id",))
    files = glob.glob(f"{tmp_dir}/one/*.parquet")
    assert len(files) == 1 and pq.read_table(files[0])["id"].to_pylist() == list(range(5000))


# --- nearest place ---


def test_far_points_meet_few_places_of_a_dense_gazetteer(spark):
    """Places crowd a northern band, points lie in the far south: candidates stay few for each point."""
    import random

    rng = random.Random(31)
    rows = [(k, f"P{k}", "XX", round(rng.uniform(40, 60), 3), round(rng.uniform(-180, 180), 3)) for k in range(6000)]
    pts = [(f"p{k}", round(rng.uniform(-85, -30), 2), round(rng.uniform(-180, 180), 2)) for k in range(200)]
    df = spark.createDataFrame(pts, "k string, LATITUDE double, LONGITUDE double")
    cand, _ = locations.candidates(df, places_df(spark, rows), "k")
    n = cand.count()
    assert n < 200 * 300, n  # of 1.2 million pairs
    from test_geo import brute, run

    assert run(spark, pts[:60], rows[:1500], None) == brute(pts[:60], rows[:1500])


def test_no_level_pairs_points_with_all_cells(spark):
    """A point's frontier on a level is bounded by its own distances, not by the number of occupied cells."""
    rows = [(k, f"P{k}", "XX", 50.0 + (k % 80) / 10, -170.0 + (k // 80) * 4.25) for k in range(80 * 80)]
    df = spark.createDataFrame([("south", -60.0, 10.0), ("inside", 53.0, 12.0)], "k string, LATITUDE double, LONGITUDE double")
    cand, _ = locations.candidates(df, places_df(spark, rows), "k", base_cell_deg=360.0 / 1024)
    per = {r.k: r["count"] for r in cand.groupBy("k").count().collect()}
    assert max(per.values()) <= 300


@pytest.mark.parametrize("bad", [7.0, 0.0, -1.0, 360.0, 100.0, 360.0 / 3])
def test_cells_that_do_not_halve_the_globe_are_refused(spark, bad):
    df = spark.createDataFrame([("a", 1.0, 1.0)], "k string, LATITUDE double, LONGITUDE double")
    with pytest.raises(ValueError, match="360/2"):
        locations.nearest_place(df, places_df(spark), "k", base_cell_deg=bad)


@pytest.mark.parametrize("growth", [0, 1, 3, 6])
def test_growth_is_a_power_of_two(spark, growth):
    df = spark.createDataFrame([("a", 1.0, 1.0)], "k string, LATITUDE double, LONGITUDE double")
    with pytest.raises(ValueError, match="power of two"):
        locations.nearest_place(df, places_df(spark), "k", growth=growth)


def test_text_keys_work_like_numbers(spark):
    df = spark.createDataFrame([("a", 0.0, 0.0)], "k string, LATITUDE double, LONGITUDE double")
    pl = spark.createDataFrame([("b", "E", "XX", 0.0, 10.0), ("a", "W", "XX", 0.0, -10.0)], "place_key string, name string, cc string, lat double, lon double")
    assert [(r.place_key, r.name) for r in locations.nearest_place(df, pl, "k").collect()] == [("a", "W")]


# --- shared folder ---


class _Conf:
    def __init__(self, value):
        self.value = value

    def get(self, *_):
        return self.value


class _Context:
    def __init__(self, master, app, folder=None):
        self.master, self.applicationId, self.folder = master, app, folder

    def getConf(self):
        return _Conf(None)

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class _Session:
    def __init__(self, master, app, setting=None):
        self.conf, self.sparkContext = _Conf(setting), _Context(master, app)


def test_a_cluster_without_the_setting_gets_an_error():
    for master in ("spark://h:7077", "local-cluster[2,1,1024]", "yarn", "k8s://x"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared_dir(_Session(master, f"app-{master}"))
    assert shared_dir(_Session("yarn", "app-set", "hdfs:///shared/")) == "hdfs:///shared"
    here = _Session("local[4]", "app-local")
    assert os.path.isdir(shared_dir(here)) and shared_dir(here) == shared_dir(here)


def test_the_session_setting_is_the_folder(spark):
    assert shared_dir(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")


def test_csv_is_read_once_and_bad_text_counted_behind_the_exchange(spark, tmp_dir):
    import os

    from meteocube import ingest_csv
    from meteocube.plans.build import observed_csv

    from helpers import plan_text

    os.makedirs(f"{tmp_dir}/csv")
    for k in range(3):
        with open(f"{tmp_dir}/csv/{k}.csv", "w") as f:
            f.write("DATE,LATITUDE,LONGITUDE,TMP,X,_bad_text_0\n2020-01-01 00:00:00,1,2,x, ,9\nq,1,2,3,4,5\n2020-01-02 00:00:00,n,2, ,,\n")
    rows, columns, _ = observed_csv(spark, f"{tmp_dir}/csv")
    plan = plan_text(rows, "simple")
    assert plan.count("FileScan csv") == 1 and plan.index("CollectMetrics") < plan.index("Exchange")
    back = ingest_csv(spark, f"{tmp_dir}/csv", f"{tmp_dir}/raw")
    assert back.columns == ["DATE", "LATITUDE", "LONGITUDE", "TMP", "X", "_bad_text_0"] and back.count() == 9
    counts = {r.column_name: r.n_bad for r in spark.read.parquet(f"{tmp_dir}/raw_bad_text").collect()}
    assert counts == {"DATE": 3, "LATITUDE": 3, "LONGITUDE": 0, "TMP": 3}


def test_csv_without_rows(spark, tmp_dir):
    import os

    from meteocube import ingest_csv

    os.makedirs(f"{tmp_dir}/csv")
    with open(f"{tmp_dir}/csv/0.csv", "w") as f:
        f.write("DATE,TMP\n")
    assert ingest_csv(spark, f"{tmp_dir}/csv", f"{tmp_dir}/raw").collect() == []
    assert {r.column_name: r.n_bad for r in spark.read.parquet(f"{tmp_dir}/raw_bad_text").collect()} == {"DATE": 0, "TMP": 0}


@pytest.mark.parametrize("layout", ["clustered", "small_files"])
def test_period_tables_are_built_from_one_pass_over_the_days(spark, tmp_dir, layout):
    from meteocube.operators.rollup import monthly_rollup, yearly_rollup

    rows = [(f"2020-{m:02d}-{d:02d} 00:00", 10.0 + s, 20.0, 0.1 * d + s, 1.0 / d, 1e10 + d, None) for m in (1, 2, 3) for d in (1, 9, 20) for s in range(6)]
    c = build(spark, raw_df(spark, rows).repartition(8), places_df(spark), f"{tmp_dir}/c", layout=layout)
    both = lambda a, b: sorted(map(tuple, a.select(b.columns).collect())) == sorted(map(tuple, b.collect()))
    assert both(c.monthly(), monthly_rollup(c.daily())) and both(c.yearly(), yearly_rollup(c.daily()))
    assert spark.read.parquet(f"{c.root}/_monthly_sums").count() == c.monthly().count() == 18


def test_an_answer_within_its_cap_can_stay_distributed(spark, tmp_dir):
    from meteocube.operators.guard import numbered

    c = many_files(spark, tmp_dir)
    args = ("daily", "TMP", "avg", "2020-01-01", "2020-01-28")
    n = 28 * 40
    status, df = answer(c, *args, cap=n, limits=None, collect=False)
    assert status == "ok" and not hasattr(df, "itertuples")
    assert answer(c, *args, cap=n - 1, limits=None, collect=False) == ("Too Large", None)
    assert answer(c, "daily", "TMP", "avg", "1890-01-01", "1890-01-05", cap=n, collect=False) == ("No Data", None)
    got = [(r.place, r.DATE, r.id) for r in numbered(df, "DATE", "id").collect()]
    _, pdf = answer(c, *args, cap=n, limits=None)
    assert sorted(got) == [(k, d, i) for k, (d, i) in enumerate(zip(pdf["DATE"], pdf["id"]), 1)] and len(got) == n


def test_the_guarded_answer_keeps_its_rows_off_the_driver(spark, monkeypatch):
    from meteocube.plans import catalog, dispatch

    monkeypatch.setattr(dispatch, "fetch", None)
    got = catalog.q_guarded_answer(spark, "/root/testdata/sf0.001").groupBy("cap_case", "status").count().collect()
    assert {(r.cap_case, r.status) for r in got} == {("above", "ok"), ("at", "ok"), ("below", "Too Large"), ("empty", "No Data")}
