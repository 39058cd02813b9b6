"""Command line: the three steps a user runs, for ``spark-submit`` or ``python -m meteocube``.

    to-parquet  CSV_DIR PARQUET_DIR                     raw CSV (header, text) -> typed parquet
    build       RAW_PARQUET PLACES_PARQUET CUBE_ROOT    all cube tables (+ rejects)
    query       CUBE_ROOT LEVEL METRIC START END [--agg A] [--id ID] [--out PATH]

``query`` applies the request rules; with ``--out`` the answer is written as
parquet by the executors, otherwise it is printed after the size guard
(at most the row cap reaches the driver).
"""

from __future__ import annotations

import argparse
import sys


def _session():
    from pyspark.sql import SparkSession

    return SparkSession.builder.appName("meteocube").getOrCreate()


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="meteocube")
    sub = p.add_subparsers(dest="cmd", required=True)
    a = sub.add_parser("to-parquet")
    a.add_argument("csv_dir")
    a.add_argument("parquet_dir")
    b = sub.add_parser("build")
    b.add_argument("raw")
    b.add_argument("places")
    b.add_argument("root")
    b.add_argument("--layout", default="clustered", choices=["clustered", "small_files", "single_file"])
    b.add_argument("--id-mode", default="cell", choices=["cell", "station"])
    q = sub.add_parser("query")
    q.add_argument("root")
    q.add_argument("level")
    q.add_argument("metric")
    q.add_argument("start")
    q.add_argument("end")
    q.add_argument("--agg", default="")
    q.add_argument("--id", default="")
    q.add_argument("--out", default=None)
    args = p.parse_args(argv)

    from .plans.build import build, ingest_csv, open_cube
    from .plans.dispatch import answer, query

    spark = _session()
    if args.cmd == "to-parquet":
        ingest_csv(spark, args.csv_dir, args.parquet_dir)
    elif args.cmd == "build":
        build(spark, spark.read.parquet(args.raw), spark.read.parquet(args.places), args.root,
              layout=args.layout, id_mode=args.id_mode)
    else:
        cube = open_cube(spark, args.root)
        if args.out:
            query(cube, args.level, args.metric, args.agg, args.start, args.end, args.id).write.mode(
                "overwrite").parquet(args.out)
        else:
            status, pdf = answer(cube, args.level, args.metric, args.agg, args.start, args.end, args.id)
            print(status if pdf is None else pdf.to_string(index=False))
            return 0 if pdf is not None else 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
