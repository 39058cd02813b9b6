"""Incremental ingest of raw readings into the stored hourly table (S1/S2 -> P1-P6 -> K2).

The batch build rewrites the hourly table from all raw files.  When station
files keep arriving in a landing folder, the same transformation runs as a
Structured Streaming query: the file source tracks which files were read, every
reading is appended to the (year, month)-partitioned table (rejects to their own
partition, as in the batch table: ``rejects_of`` reads them), and the checkpoint
in the shared folder makes a restarted query (or a lost executor) resume without
duplicates or gaps.  ``availableNow`` processes everything that has landed and
stops, so it can run as a scheduled batch job too.  The files of a micro-batch are
as many as its tasks wrote; a build over the landing folder gives the clustered table.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.hourly import stored_hourly
from ..schema import RAW_SCHEMA
from ..session import scratch_path
from ..sources.raw import type_raw


def start_hourly_ingest(spark: SparkSession, source_dir: str, target_dir: str, checkpoint: str | None = None,
                        fmt: str = "parquet", schema: T.StructType = RAW_SCHEMA, text_columns: list[str] | None = None,
                        id_mode: str = "cell", files_per_batch: int | None = None,
                        available_now: bool = True) -> StreamingQuery:
    """Start the streaming ingest; returns the running query.

    ``fmt='parquet'`` reads typed raw files with ``schema``.  ``fmt='csv'`` reads
    header CSV as text (``text_columns`` in file order, all STRING) and types it
    with ``try_cast`` like the batch CSV reader.
    """
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if fmt == "csv":
        cols = text_columns or [f.name for f in schema.fields]
        text = T.StructType([T.StructField(c, T.StringType()) for c in cols])
        raw = type_raw(reader.schema(text).option("header", True).csv(source_dir), schema)
    elif fmt == "parquet":
        raw = reader.schema(schema).parquet(source_dir)
    else:
        raise ValueError(f"fmt must be 'parquet' or 'csv', got {fmt!r}")
    writer = (stored_hourly(raw, id_mode).writeStream.format("parquet").outputMode("append")
              .partitionBy("year", "month")
              .option("checkpointLocation", checkpoint or scratch_path(spark, "ingest-checkpoint")))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start(target_dir)


def run_hourly_ingest(spark: SparkSession, source_dir: str, target_dir: str, **kwargs) -> None:
    """Process every file that has landed, then stop."""
    q = start_hourly_ingest(spark, source_dir, target_dir, available_now=True, **kwargs)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
