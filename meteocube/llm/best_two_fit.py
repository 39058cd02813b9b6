"""Packing by best-two-fit: greedy fill, then two unpacked documents for a bin's smallest one where they fit its gap more tightly.

A document of n ids (end id included) up to ``capacity`` is one item. A longer one is cut into pieces of ``capacity`` ids, each a
sequence by itself, but for the first piece, which holds the rest and is an item. Items of equal length are alike to the
packing, so a bin is planned once for all bins of the same content, from the count of every length:

* Greedy: the longest length left, then again and again the longest that fits into the gap.
* Best two: with the bin's smallest item taken out, the pair of unpacked lengths that fills the expanded gap best goes in,
  if it fills it more tightly than that item did; the item is unpacked again. Repeated until no pair fits more tightly.

The driver sees ``capacity`` counts and plans at most a few bins' contents for each length, whatever the number of documents.
Items are numbered within their length where they are encoded (input partition and place there; only counts for each partition and
length are shuffled), so neither ids nor a frequent length pass through one task, and the plan, a table over (length, number),
gives each item its sequence and place.

Defined results: a null text is an empty text (one piece: the end id); repeated rows are packed each; a null doc_id keeps its
pieces under a null id; an empty table gives no pieces; lengths that tie are alike, and which of two equally long documents
goes where follows from the order of the input. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meteocube.llm.bulk_bpe import byte_texts
from meteocube.llm.common import materialize, table, text_slices
from meteocube.llm.tokens import BYTE_BPE, END_ID, ragged_binary, vocabulary, with_end

CAPACITY = 1024
#: Rows (input partitions x lengths, three numbers each) up to which the first numbers are broadcast; beyond, the join shuffles.
MOST_BROADCAST = 500_000


# --- the plan ---


@dataclass(frozen=True)
class Plan:
    """Bins by content: ``contents[k]`` are lengths, longest first, of each of ``times[k]`` bins."""

    contents: list[list[int]]
    times: list[int]

    @property
    def bins(self) -> int:
        return sum(self.times)

    def segments(self) -> dict[str, np.ndarray]:
        """For every length, runs of item numbers that go to the bins of one content at one place: sorted by (length, first)."""
        used: dict[int, int] = {}
        rows, base = [], 0
        for lengths, times in zip(self.contents, self.times, strict=True):
            offset = 0
            for n in lengths:
                rows.append((n, used.get(n, 0), base, offset))
                used[n] = used.get(n, 0) + times
                offset += n
            base += times
        rows.sort()
        columns = np.array(rows, np.int64).reshape(-1, 4).T
        return dict(zip(("length", "first", "base", "offset"), columns, strict=True))


def plan_bins(counts: np.ndarray, capacity: int = CAPACITY) -> Plan:
    """Best-two-fit over items given as ``counts[n]`` items of length n (0 <= n <= capacity)."""
    left = np.zeros(capacity + 1, np.int64)
    left[: len(counts)] = counts
    left[0] = 0
    contents, times = [], []
    while left.any():
        room, lengths = left.copy(), []
        gap = capacity
        while gap > 0:
            fit = np.flatnonzero(room[: gap + 1])
            if not len(fit):
                break
            lengths.append(int(fit[-1]))
            room[fit[-1]] -= 1
            gap -= int(fit[-1])
        while gap > 0 and len(lengths) > 1:
            small = min(lengths)
            pair = best_pair(room, gap + small)
            if pair is None or sum(pair) <= small:
                break
            lengths.remove(small)
            lengths += pair
            room[small] += 1
            for n in pair:
                room[n] -= 1
            gap -= sum(pair) - small
        kinds, often = np.unique(lengths, return_counts=True)
        n = int((left[kinds] // often).min())
        left[kinds] -= n * often
        contents.append(sorted(lengths, reverse=True))
        times.append(n)
    return Plan(contents, times)


def best_pair(room: np.ndarray, gap: int) -> list[int] | None:
    """The two unpacked lengths with the largest sum up to ``gap``, the longer one as long as can be."""
    have = np.flatnonzero(room[: gap + 1])
    if not len(have):
        return None
    # For each first length, the longest second one, not longer than the first, that still fits.
    most = np.minimum(have, gap - have)
    at = np.searchsorted(have, most, side="right") - 1
    alone = (at >= 0) & (have[np.maximum(at, 0)] == have) & (room[have] < 2)
    at = at - alone
    total = np.where(at >= 0, have + have[np.maximum(at, 0)], -1)
    k = len(total) - 1 - int(np.argmax(total[::-1]))
    return None if total[k] < 0 else [int(have[k]), int(have[at[k]])]


# --- pieces ---


def piece_lengths(n: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, piece, length) of documents of n >= 1 ids each."""
    pieces = -(-n // capacity)
    doc = np.repeat(np.arange(len(n)), pieces)
    piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    length = np.where(piece == 0, n[doc] - (pieces[doc] - 1) * capacity, capacity)
    return doc, piece, length


def pieces(docs: DataFrame, path: str, end_id: int = END_ID, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids (unsigned 32-bit) and the place (part, slot) among the pieces of that length."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for rows, text in text_slices(batches, "text"):
            ids, bounds = with_end(*byte_texts(path, text), end_id)
            doc, piece, length = piece_lengths(np.diff(bounds), capacity)
            cuts = np.concatenate([[0], np.cumsum(length)])
            by_length = np.argsort(length, kind="stable")
            counts = np.bincount(length, minlength=capacity + 1)
            slot = np.empty(len(length), np.int64)
            slot[by_length] = np.arange(len(length)) - np.repeat(np.cumsum(counts) - counts - seen, counts)
            seen += counts
            yield pa.RecordBatch.from_arrays(
                [rows.column(0).take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(cuts[:-1] - bounds[doc]), pa.array(length), ragged_binary(ids, cuts), pa.array(np.full(len(doc), part, np.int64)), pa.array(slot)],
                names=["doc_id", "piece", "start", "length", "ids", "part", "slot"],
            )

    schema = "doc_id long, piece int, start long, length long, ids binary, part long, slot long"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(task, schema)


def pack(docs: DataFrame, path: str, end_id: int = END_ID, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids, sequence_id, offset of every piece."""
    if capacity < 1:
        raise ValueError("capacity must be positive")
    spark = docs.sparkSession
    made = materialize(pieces(docs, path, end_id, capacity), "two-fit-pieces")
    counts = made.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    # One row for each input partition and length; a window holds the partitions of one length.
    before = F.sum("n").over(W.partitionBy("length").orderBy("part")) - F.col("n")
    before = materialize(counts.select("length", "part", "n", before.alias("before")), "two-fit-before")
    # At most ``capacity`` rows.
    total = np.zeros(capacity + 1, np.int64)
    for r in before.groupBy("length").agg(F.sum("n").alias("n")).collect():
        total[r.length] = r.n
    plan = plan_bins(total, capacity)
    at = plan.segments()
    firsts = before.select(F.col("length").alias("_length"), F.col("part").alias("_part"), "before")
    if before.count() <= MOST_BROADCAST:
        firsts = F.broadcast(firsts)
    numbered = made.join(firsts, (F.col("length") == F.col("_length")) & (F.col("part") == F.col("_part")))
    numbered = numbered.select("doc_id", "piece", "start", "length", "ids", (F.col("before") + F.col("slot")).alias("number"))
    if len(at["length"]) == 0:
        return numbered.select("doc_id", "piece", "start", "length", "ids", F.col("number").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Segments of a length follow one another from item 0, so the last one that starts at or before the item holds it.
        width = int(total.max()) + 1
        keys = at["length"] * width + at["first"]
        for batch in batches:
            length, number = (batch.column(k).to_numpy(zero_copy_only=False) for k in (3, 5))
            k = np.searchsorted(keys, length * width + number, side="right") - 1
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(at["base"][k] + number - at["first"][k]), pa.array(at["offset"][k])], names=["doc_id", "piece", "start", "length", "ids", "sequence_id", "offset"])

    return numbered.mapInArrow(place, "doc_id long, piece int, start long, length long, ids binary, sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): each sequence's ids in order, no longer than the capacity."""
    runs = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("runs"))
    joined = F.aggregate("runs", F.lit(b"").cast("binary"), lambda out, x: F.concat(out, x["ids"]))
    return runs.select("sequence_id", joined.alias("ids"))


def digest(packed: DataFrame) -> DataFrame:
    return packed.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


def op12_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(pack(table(spark, sf_dir, "documents"), vocabulary(BYTE_BPE)))
