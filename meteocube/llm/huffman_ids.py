"""Token-id files: canonical length-limited Huffman codes from global counts, in independent blocks.

Format (a folder that Spark's writer commits, so a lost task leaves nothing behind):

* ``codebook``: one row (id, length) for every id in use. Codes are canonical: by length, then id.
* ``blocks``: one row per block, files and blocks in ascending doc_id order (part, block):
  ``doc_ids`` (int64) and ``doc_lengths`` (uint32) of its whole documents, ``start`` (ids before it in its part),
  ``n_ids``, ``payload`` (codes, most significant bit first), and ``checkpoints`` (uint64): the bit offset
  of every ``STEP``-th id.

A block is decoded by itself with one table of 2 ** longest code entries; the checkpoints are decoded side by side,
one table step for all of them at a time.

Defined results: a null text is an empty text (the end id alone); rows that repeat a doc_id each keep their ids, one after the
other in the order of a hash of their ids (the same in every run); a null doc_id sorts first; an empty table gives a folder without blocks; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meteocube.llm.common import materialize, scratch, table
from meteocube.llm.tokens import END_ID, WORD_BPE, encode_documents, narrow, ragged_binary, ragged_ids, vocabulary

STEP = 128
BLOCK_IDS = 1 << 18
LIMIT = 18
NULL_ID = np.iinfo(np.int64).min

BLOCKS = "part long, block long, start long, n_ids long, doc_ids binary, doc_lengths binary, checkpoints binary, payload binary"


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits for positive counts (package-merge)."""
    n = len(counts)
    if n <= 1:
        return np.ones(n, np.int64)
    limit = max(limit, int(np.ceil(np.log2(n))))
    order = np.argsort(counts, kind="stable")
    leaves = counts[order].astype(np.float64)
    is_leaf: list[np.ndarray] = []
    packages = np.zeros(0)
    for _ in range(limit):
        merged = np.concatenate([leaves, packages])
        by = np.argsort(merged, kind="stable")
        is_leaf.append(by < n)
        merged = merged[by]
        even = len(merged) // 2 * 2
        packages = merged[0:even:2] + merged[1:even:2]
    lengths = np.zeros(n, np.int64)
    take = 2 * n - 2
    for level in reversed(is_leaf):
        chosen = int(level[:take].sum())
        lengths[:chosen] += 1
        take = 2 * (take - chosen)
    out = np.zeros(n, np.int64)
    out[order] = lengths
    return out


class Code:
    """Canonical code of ids with the given lengths."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray):
        order = np.lexsort((ids, lengths))
        self.ids, self.lengths = ids[order].astype(np.int64), lengths[order].astype(np.int64)
        self.longest = int(self.lengths[-1]) if len(ids) else 1
        steps = np.left_shift(np.int64(1), self.longest - self.lengths)
        first = np.cumsum(steps) - steps  # each code, left-aligned to the longest
        self.codes = np.right_shift(first, self.longest - self.lengths)
        size = int(self.ids.max()) + 1 if len(ids) else 0
        self.code_of, self.length_of = np.zeros(size, np.uint64), np.zeros(size, np.int64)
        self.code_of[self.ids] = self.codes.astype(np.uint64)
        self.length_of[self.ids] = self.lengths
        filled = int(steps.sum()) if len(ids) else 0
        self.table_id = np.zeros(1 << self.longest, np.uint32)
        self.table_length = np.ones(1 << self.longest, np.int64)
        self.table_id[:filled] = np.repeat(self.ids, steps)
        self.table_length[:filled] = np.repeat(self.lengths, steps)

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """(payload, bit offsets of every STEP-th id)."""
        n = self.length_of[ids]
        ends = np.cumsum(n)
        at = ends - n
        total = int(ends[-1]) if len(ids) else 0
        words = np.zeros(total // 64 + 2, np.uint64)
        code, word, used = self.code_of[ids], at >> 6, (at & 63) + n
        over = used > 64
        left = np.where(over, 0, 64 - used).astype(np.uint64)
        spill = np.where(over, used - 64, 0).astype(np.uint64)
        inside = np.where(over, code >> spill, code << left)
        if len(ids):
            starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            words[word[starts]] = np.bitwise_or.reduceat(inside, starts)
            rest = (64 - spill[over]).astype(np.uint64)
            words[word[over] + 1] |= code[over] << rest  # at most one code crosses into a word
        return words.astype(">u8").tobytes()[: (total + 7) // 8], at[::STEP].astype(np.uint64)

    def decode(self, payload: bytes, checkpoints: np.ndarray, n: int) -> np.ndarray:
        raw = np.frombuffer(payload + bytes(8 + STEP * self.longest // 8), np.uint8).astype(np.uint32)
        window = (raw[:-3] << np.uint32(24)) | (raw[1:-2] << np.uint32(16)) | (raw[2:-1] << np.uint32(8)) | raw[3:]
        at = checkpoints.astype(np.int64)
        out = np.zeros((len(at), STEP), np.uint32)
        down = np.uint32(32 - self.longest)
        for k in range(STEP):
            # Only the last run can end early; what it reads past its end is cut off below.
            key = (window[np.minimum(at >> 3, len(window) - 1)] << (at & 7).astype(np.uint32)) >> down
            out[:, k] = self.table_id[key]
            at += self.table_length[key]
        return out.ravel()[:n]


def count_ids(encoded: DataFrame, kind: str = "<u4") -> DataFrame:
    """(id, n) over all documents; every partition adds up its own first."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            ids, _ = ragged_ids(batch.column(0), kind)
            if len(ids):
                more = np.bincount(ids)
                total = np.pad(total, (0, max(0, len(more) - len(total))))
                total[: len(more)] += more
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["id", "n"])

    return encoded.select("ids").mapInArrow(task, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write(encoded: DataFrame, path: str, step_ids: int = BLOCK_IDS, kind: str = "<u4") -> None:
    """Write (doc_id, ids) as files of the format in ascending doc_id order; ``kind``: the integer type of the ids."""
    spark = encoded.sparkSession
    counts = count_ids(encoded, kind).orderBy("id").collect()  # as many rows as the vocabulary has ids
    ids = np.array([r.id for r in counts], np.int64)
    lengths = code_lengths(np.array([r.n for r in counts], np.int64))
    book = spark.createDataFrame(list(zip(ids.tolist(), lengths.tolist(), strict=True)), "id long, length long")
    book.coalesce(1).write.parquet(f"{path}/codebook")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, part = Code(ids, lengths), TaskContext.get().partitionId()
        docs: list[np.ndarray] = []
        held: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        start = block = n = 0

        def flush() -> pa.RecordBatch:
            nonlocal start, block, n
            flat = np.concatenate(held)
            payload, marks = code.encode(flat)
            row = [part, block, start, len(flat), np.concatenate(docs).astype("<i8").tobytes(), np.concatenate(sizes).astype("<u4").tobytes(), marks.astype("<u8").tobytes(), payload]
            start, block, n = start + len(flat), block + 1, 0
            docs.clear(), held.clear(), sizes.clear()
            names = [f.split()[0] for f in BLOCKS.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([v], pa.binary() if isinstance(v, bytes) else pa.int64()) for v in row], names=names)

        for batch in batches:
            flat, bounds = ragged_ids(batch.column(1), kind)
            key = batch.column(0).fill_null(NULL_ID).to_numpy()
            at = 0
            while at < len(key):
                to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + step_ids - n, side="right")) - 1)
                held.append(flat[bounds[at] : bounds[to]])
                docs.append(key[at:to])
                sizes.append(np.diff(bounds[at : to + 1]))
                n += int(bounds[to] - bounds[at])
                if n >= step_ids or to < len(key):
                    yield flush()
                at = to
        if docs:
            yield flush()

    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # Rows that repeat an id go by their ids, so that starts do not depend on the run, and over as many ranges as they need.
    order = [F.col("doc_id").asc_nulls_first(), "_ids_hash"]
    ordered = encoded.select("doc_id", "ids", F.xxhash64("ids").alias("_ids_hash"), F.monotonically_increasing_id().alias("_row"))
    ordered = ordered.repartitionByRange(parts, *order, "_row").sortWithinPartitions(*order, "ids").select("doc_id", "ids")
    # Payloads are at their entropy already.
    ordered.mapInArrow(task, BLOCKS).write.option("compression", "none").parquet(f"{path}/blocks")


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, ids) of every document of the files: ids as unsigned 32-bit, start = ids of all documents before it."""
    book = spark.read.schema("id long, length long").parquet(f"{path}/codebook").collect()  # the vocabulary
    ids, lengths = (np.array([r[k] for r in book], np.int64) for k in (0, 1))
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    # One row per file of the format, however many documents it holds.
    sums = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = sums.select(F.col("part").alias("_part"), (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("before"))
    before = materialize(before, "part-starts")  # small files: the blocks are joined where they lie, not shuffled
    blocks = blocks.join(before, blocks.part == before._part).select("before", "start", "n_ids", "doc_ids", "doc_lengths", "checkpoints", "payload")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Code(ids, lengths)
        for batch in batches:
            for r in range(batch.num_rows):
                before, start, n, docs, sizes, marks, payload = (c[r].as_py() for c in batch.columns)
                flat = code.decode(payload, np.frombuffer(marks, "<u8"), n)
                bounds = np.concatenate([[0], np.cumsum(np.frombuffer(sizes, "<u4").astype(np.int64))])
                key = np.frombuffer(docs, "<i8")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key, mask=key == NULL_ID), pa.array(bounds[:-1] + before + start), ragged_binary(flat, bounds)], names=["doc_id", "start", "ids"]
                )

    return blocks.mapInArrow(task, "doc_id long, start long, ids binary")


def op5_huffman_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = vocabulary(WORD_BPE)
    encoded = materialize(encode_documents(table(spark, sf_dir, "documents"), words, END_ID, narrow(words)), "token-ids")
    path = scratch(spark, "huffman")
    write(encoded, path, kind=narrow(words))
    out = read(spark, path)
    return out.select("doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
