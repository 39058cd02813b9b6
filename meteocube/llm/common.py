"""Helpers shared by the training-data operators: inputs, lineage cuts, Arrow batches."""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meteocube.session import shared_dir

#: Text handled at once inside a task; only bounds memory, never the result.
SLICE_BYTES = 4 << 20

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The given table, and the package's folder on the Python workers' path."""
    path = spark.sparkContext.environment.get("PYTHONPATH", "")
    if _ROOT not in path.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (_ROOT, path) if x)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` to the shared folder and continue from the files (lineage cut)."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(name: str, df: DataFrame) -> str:
    """A column name that ``df`` does not have."""
    while name in df.columns:
        name += "_"
    return name


def held_out(doc_id: Column) -> Column:
    """Rows whose label is never learned from: crc32(doc_id as text) mod 5 is 0 (null id: false)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def training_labels(labels: DataFrame, column: str) -> DataFrame:
    """One row (label_id, y in 0..1, fold 1..4) per labelled id that may be learned from.

    Null ids and null labels are left out; an id labelled twice gets the mean of its labels.
    """
    return (
        labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").alias("label_id"))
        .agg(F.avg(F.col(column).cast("double")).alias("y"))
        .withColumn("fold", fold(F.col("label_id")))
    )


def plain_strings(text: pa.Array | pa.ChunkedArray) -> pa.Array:
    """Contiguous large-string array with nulls read as empty texts."""
    if isinstance(text, pa.ChunkedArray):
        text = text.combine_chunks()
    return pc.fill_null(text.cast(pa.large_string()), "")


def text_slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """(rows, their texts) with about ``limit`` bytes of text each; a single longer text comes alone and whole."""
    for batch in batches:
        text = plain_strings(batch.column(batch.schema.get_field_index(column)))
        ends = np.frombuffer(text.buffers()[1], dtype=np.int64)[text.offset : text.offset + len(text) + 1] if len(text) else np.zeros(1, np.int64)
        at = 0
        while at < len(text):
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + limit, side="right")) - 1)
            yield batch.slice(at, to - at), text.slice(at, to - at)
            at = to


def binary_array(chunks: list[bytes]) -> pa.Array:
    return pa.array(chunks, type=pa.binary())


def crc32_u32(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())
