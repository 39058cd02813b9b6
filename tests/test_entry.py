import datetime as dt

import __spark_entry__ as E
from meteocube.plans import catalog


def test_registry_has_oracle_for_every_query():
    core = catalog.spark_queries()
    assert set(core) == set(catalog.oracle_queries()) and len(core) >= 46
    assert set(core) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs_on_smallest_scale(spark):
    df = E.entry(spark)
    assert df.columns == ["DATE", "avgTMP"]
    rows = df.collect()
    assert all(dt.date(1997, 1, 1) <= r.DATE <= dt.date(1997, 1, 24) for r in rows)


def test_some_queries_match_oracle_at_smallest_scale(spark):
    import duckdb

    con = duckdb.connect()
    for t in ("supplier", "lineitem", "events", "nation"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('/root/testdata/sf0.001/{t}.parquet')")
    q, sql = E.queries(), E.oracle_sql()
    for name in ("daily_rollup", "monthly_rollup", "location_dim", "snapshot_monthly"):
        df = q[name](spark, "/root/testdata/sf0.001")
        got = sorted((tuple(sorted(r.asDict().items())) for r in df.collect()), key=repr)
        cur = con.execute(sql[name])
        cols = [d[0] for d in cur.description]
        want = sorted((tuple(sorted(zip(cols, r))) for r in cur.fetchall()), key=repr)
        assert got == want, name


def test_flagship_equals_registered_series(spark):
    a = E.entry(spark)
    b = E.queries()["series_daily"](spark, "/root/testdata/sf0.001")
    assert a.schema == b.schema
    assert a.collect() == b.collect()
