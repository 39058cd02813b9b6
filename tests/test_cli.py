from meteocube.__main__ import main

from helpers import raw_df


def test_cli_to_parquet_build_query(spark, tmp_dir, capsys):
    rows = [(f"2020-01-{d:02d} {h:02d}:00", 33.68, -117.87, float(d), 1.0, 2.0, 1000.0) for d in (1, 2) for h in (0, 12)]
    raw_df(spark, rows).write.option("header", True).csv(f"{tmp_dir}/csv")
    spark.createDataFrame([(1, "Irvine", "US", 33.68, -117.82)],
                          "place_key long, name string, cc string, lat double, lon double").write.parquet(f"{tmp_dir}/places")
    assert main(["to-parquet", f"{tmp_dir}/csv", f"{tmp_dir}/raw"]) == 0
    assert main(["build", f"{tmp_dir}/raw", f"{tmp_dir}/places", f"{tmp_dir}/cube"]) == 0
    capsys.readouterr()
    assert main(["query", f"{tmp_dir}/cube", "daily", "TMP", "2020-01-01", "2020-01-02", "--agg", "max"]) == 0
    out = capsys.readouterr().out
    assert "Irvine, US" in out and "2020-01-02" in out
    assert main(["query", f"{tmp_dir}/cube", "yearly", "TMP", "2030-01-01", "2030-01-02", "--agg", "avg"]) == 1
    assert "No Data" in capsys.readouterr().out
    assert main(["query", f"{tmp_dir}/cube", "daily", "TMP", "2020-01-01", "2020-01-02", "--agg", "avg",
                 "--id", "12300-6213", "--out", f"{tmp_dir}/answer"]) == 0
    assert [r.avgTMP for r in spark.read.parquet(f"{tmp_dir}/answer").orderBy("DATE").collect()] == [1.0, 2.0]
