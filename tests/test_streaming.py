from meteocube.operators.hourly import fact_of, rejects_of
from meteocube.streaming import run_hourly_ingest

from helpers import raw_df


def test_restart_appends_only_new_files(spark, tmp_dir):
    landing, target, ckpt = f"{tmp_dir}/landing", f"{tmp_dir}/hourly", f"{tmp_dir}/ckpt"
    raw_df(spark, [("2020-01-01 00:00", 33.68, -117.87, 1.0, 2.0, 3.0, 4.0)]).write.mode("append").parquet(landing)
    run_hourly_ingest(spark, landing, target, checkpoint=ckpt)
    assert spark.read.parquet(target).count() == 1
    raw_df(spark, [("2020-02-01 00:00", 33.68, -117.87, 5.0, 2.0, 3.0, 4.0),
                   ("2020-02-01 01:00", None, -117.87, 5.0, 2.0, 3.0, 4.0)]).write.mode("append").parquet(landing)
    run_hourly_ingest(spark, landing, target, checkpoint=ckpt)   # resumes from the checkpoint
    stored = spark.read.parquet(target)
    rows = fact_of(stored).orderBy("DATE").collect()
    assert [(r.LATITUDE, r.TMP) for r in rejects_of(stored).collect()] == [(None, 5.0)]  # nothing is dropped
    assert [(r.TMP, r.id, r.year, r.month) for r in rows] == [(1.0, "12300-6213", 2020, 1), (5.0, "12300-6213", 2020, 2)]


def test_csv_stream_types_text_like_batch(spark, tmp_dir):
    import os

    landing = f"{tmp_dir}/csv"
    os.makedirs(landing)
    with open(f"{landing}/a.csv", "w") as f:
        f.write("DATE,LATITUDE,LONGITUDE,TMP,DEW,WND_RATE,SLP\n")
        f.write("2020-01-01 00:00:00,33.68,-117.87,1.5,abc,2,1000\n")
        f.write("2020-01-01 01:00:00,33.68,,1.5,1,2,1000\n")
    run_hourly_ingest(spark, landing, f"{tmp_dir}/out", checkpoint=f"{tmp_dir}/ck", fmt="csv")
    rows = fact_of(spark.read.parquet(f"{tmp_dir}/out")).collect()
    assert [(r.TMP, r.DEW, r.WIND) for r in rows] == [(1.5, None, 2.0)]
