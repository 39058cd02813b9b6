"""Packing by power-of-two decomposition: every document is cut into pieces of binary length, bucketed by length.

A document of n ids (end id included) gives n // longest pieces of ``longest`` ids and one piece for each bit of the
rest, largest first. A piece is a sequence by itself, so no sequence crosses documents and, its length being a power
of two, none is padded. Sequences are numbered bucket by bucket, longest first, so that a batch of equal lengths
is a range of sequence ids.

Defined results: a null text is an empty text (one piece: the end id); repeated rows are packed each; a null doc_id keeps
its pieces under a null id; an empty table gives no pieces; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meteocube.llm.common import materialize, table, text_slices
from meteocube.llm.tokens import END_ID, WORD_BPE, encode_slice, ragged_binary, vocabulary, with_end

LONGEST = 4096


def piece_lengths(n: np.ndarray, longest: int = LONGEST) -> tuple[np.ndarray, np.ndarray]:
    """(document number, length) of the pieces of documents with n ids each, in document order."""
    powers = 2 ** np.arange(int(np.log2(longest)) - 1, -1, -1)
    whole = n // longest
    rest = (n % longest)[:, None] & powers[None, :]
    each = np.column_stack([whole, rest > 0]).ravel()
    value = np.tile(np.concatenate([[longest], powers]), len(n))
    doc = np.repeat(np.arange(len(n)), 1 + len(powers))
    return np.repeat(doc, each), np.repeat(value, each)


def pieces(docs: DataFrame, path: str, end_id: int = END_ID, longest: int = LONGEST) -> DataFrame:
    """doc_id, start, length, doc_tokens, ids (unsigned 32-bit) of every piece, and its place (part, slot) in its bucket."""
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        seen = np.zeros(int(np.log2(longest)) + 1, np.int64)
        for rows, text in text_slices(batches, "text"):
            ids, bounds = with_end(*encode_slice(path, text), end_id)
            n = np.diff(bounds)
            doc, length = piece_lengths(n, longest)
            cuts = np.concatenate([[0], np.cumsum(length)])
            bucket = np.log2(length).astype(np.int64)
            slot = np.zeros(len(length), np.int64)
            for b in np.unique(bucket):
                here = bucket == b
                slot[here] = seen[b] + np.arange(here.sum())
                seen[b] += here.sum()
            yield pa.RecordBatch.from_arrays(
                [rows.column(0).take(pa.array(doc)), pa.array(cuts[:-1] - bounds[doc]), pa.array(length.astype(np.int64)), pa.array(n[doc]), ragged_binary(ids, cuts), pa.array(np.full(len(doc), part, np.int64)), pa.array(slot)],
                names=["doc_id", "start", "length", "doc_tokens", "ids", "part", "slot"],
            )

    schema = "doc_id long, start long, length long, doc_tokens long, ids binary, part long, slot long"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(task, schema)


def pack(docs: DataFrame, path: str, end_id: int = END_ID, longest: int = LONGEST) -> DataFrame:
    """doc_id, start, length, doc_tokens, ids, sequence_id, offset of every piece."""
    made = materialize(pieces(docs, path, end_id, longest), "pieces")
    # A bucket's pieces of each input partition are numbered in the task; only the counts, one row for each
    # partition and bucket, are added up: inside a bucket by a window, and over the buckets (one for each bit) on the driver.
    counts = made.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    within = F.sum("n").over(W.partitionBy("length").orderBy("part")) - F.col("n")
    first = materialize(counts.select(F.col("length").alias("_length"), F.col("part").alias("_part"), "n", within.alias("within")), "bucket-starts")
    bucket_start, total = F.lit(0).cast("long"), 0
    for r in sorted(first.groupBy("_length").agg(F.sum("n").alias("n")).collect(), key=lambda r: -r._length):
        bucket_start = F.when(F.col("_length") == r._length, F.lit(total).cast("long")).otherwise(bucket_start)
        total += r.n
    first = first.select("_length", "_part", (bucket_start + F.col("within")).alias("first"))
    out = made.join(first, (F.col("length") == F.col("_length")) & (F.col("part") == F.col("_part")))
    return out.select("doc_id", "start", "length", "doc_tokens", "ids", (F.col("first") + F.col("slot")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))


def write_buckets(packed: DataFrame, path: str) -> None:
    """One folder for each length: batches of equal lengths are read without a filter."""
    packed.write.partitionBy("length").option("compression", "zstd").parquet(path)


def digest(packed: DataFrame) -> DataFrame:
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op6_pack_pow2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(pack(table(spark, sf_dir, "documents"), vocabulary(WORD_BPE)))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return digest(pack(docs, vocabulary(WORD_BPE)))
