"""SimHash near-dedup: an inverted index over positional bytes with count filtering.

A fingerprint has 8 positional bytes. Two fingerprints that differ in at most 3 bits differ in at most 3 bytes, so
they share at least 5 positional bytes: the guaranteed minimum. Of any 5 positions, 3 lie in one half of 4; so such
a pair shares one of the 8 triples of positions within a half. The index lists the different fingerprints
under each of their 8 triples (24 bits a key); the pairs that meet in a list tally their shared positional bytes, pairs
under the minimum are dropped, and the rest are verified bit by bit.

Scale: equal fingerprints are one entry; lists are met block by block whatever their length
(``graph.list_blocks``); a run of blocks returns one representative for each linked entry, not the pairs.

Defined results: a null text is an empty text; a text without words has fingerprint zero and links like any
other; with fewer words than a shingle the whole sequence is the shingle; repeated shingles count repeatedly; repeated
rows share a fingerprint and so a component; a null doc_id takes part but cannot name a component (null when
nothing else is in it); an empty table gives an empty result; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meteocube.llm.common import fresh, materialize, table, text_slices
from meteocube.llm.graph import components, forest, list_blocks, over_groups, pairs_in_groups

SHINGLE = 3
DISTANCE = 3
SEED = 42
BYTES = 8

#: Triples of byte positions within either half of the fingerprint.
TRIPLES = [t for half in (range(0, 4), range(4, 8)) for t in itertools.combinations(half, 3)]


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Fingerprint of one UTF-8 text as a signed 64-bit number."""
    words = text.lower().split()  # of bytes: A-Z only, ASCII white space only
    if not words:
        return 0
    plain = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(words) <= shingle:
        starts, ends = [0], [len(plain)]
    else:
        starts, ends = starts[:n].tolist(), ends[shingle - 1 :].tolist()
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 32768):
        part = zip(starts[at : at + 32768], ends[at : at + 32768], strict=True)
        h = np.array([xxhash.xxh64_intdigest(plain[a:b], SEED) for a, b in part], dtype="<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > n, bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) for every row; one pass, no shuffle."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, text in text_slices(batches, "text"):
            fp = [fingerprint(t, shingle) for t in text.cast(pa.large_binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(fp, pa.int64())], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(task, "doc_id long, fp long")


def index(entries: DataFrame) -> DataFrame:
    """(key, fp): every fingerprint under its 8 byte triples; a key holds the triple's number and its bytes."""
    byte = lambda p: F.shiftrightunsigned("fp", 8 * p).bitwiseAND(255)

    def key(number: int, triple: tuple[int, int, int]) -> Column:
        a, b, c = (byte(p) for p in triple)
        return F.lit(number).cast("long") * (1 << 24) + a * 65536 + b * 256 + c

    keys = F.array(*[key(n, t) for n, t in enumerate(TRIPLES)])
    return entries.select(F.explode(keys).alias("key"), "fp")


def fingerprint_links(entries: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(a, b): links enough to connect the different fingerprints that differ in at most ``distance`` bits."""
    if not 0 <= distance <= 3:
        raise ValueError("the triples of this index guarantee distances up to 3")
    shared = BYTES - distance

    def meet(t: pa.Table, bounds: np.ndarray) -> pa.RecordBatch:
        fp = t.column("fp").to_numpy()
        lo, hi, side = (t.column(c).to_numpy() for c in ("lo", "hi", "side"))
        found_i, found_j = [], []
        for i, j in pairs_in_groups(bounds, lo, hi, side):
            differ = (fp[i] ^ fp[j]).view(np.uint64)
            tally = (differ.view(np.uint8).reshape(-1, BYTES) == 0).sum(axis=1)
            near = tally >= shared
            near[near] = np.bitwise_count(differ[near]) <= distance
            found_i.append(i[near])
            found_j.append(j[near])
        i = np.concatenate(found_i) if found_i else np.zeros(0, np.int64)
        j = np.concatenate(found_j) if found_j else np.zeros(0, np.int64)
        # A forest over the different fingerprints of this run says as much as all its pairs.
        values, place = np.unique(fp, return_inverse=True)
        root = forest(len(values), place[i], place[j])
        own = np.arange(len(values))
        return pa.RecordBatch.from_arrays([pa.array(values[own != root]), pa.array(values[root[own != root]])], names=["a", "b"])

    groups = list_blocks(index(entries), "key", "fp")
    return over_groups(groups, "key", meet, "a long, b long", rows=32768)


def _entries(prints: DataFrame, distance: int) -> DataFrame:
    """(fp, root, low_id, component_id) for every different fingerprint of (doc_id, fp)."""
    entries = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("low_id")), "entries")
    root = components(fingerprint_links(entries.select("fp"), distance))
    known = entries.join(root, entries.fp == root.node, "left").select("fp", "low_id", F.coalesce("root", "fp").alias("root"))
    known = materialize(known, "entry-roots")
    low = materialize(known.groupBy("root").agg(F.min("low_id").alias("component_id")), "component-ids")
    return materialize(known.join(low, "root").select("fp", "root", "low_id", "component_id"), "entry-components")


def classes(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """(doc_id, fp, component_id) for every row."""
    prints = materialize(fingerprints(docs, shingle), "fingerprints")
    return prints.join(_entries(prints, distance), "fp").select("doc_id", "fp", "component_id")


def hex16(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def op8_simhash_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = classes(table(spark, sf_dir, "documents"))
    return out.select("doc_id", hex16(F.col("fp")).alias("fingerprint"), "component_id")


def keep(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row of ``docs`` (all its columns) for each group: that of its smallest doc_id.

    Of a group's rows that repeat that doc_id one with the smallest fingerprint stays; rows of another group stay apart,
    whether or not their doc_id is the same. A group without any doc_id keeps one row.
    """
    own, row = fresh("_fp", docs), fresh("_row", docs)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, text in text_slices(batches, "text"):
            fp = [fingerprint(t, shingle) for t in text.cast(pa.large_binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(fp, pa.int64())], names=[*rows.schema.names, own])

    # The texts are fingerprinted once; what follows knows a row by its number.
    printed = docs.mapInArrow(task, T.StructType([*docs.schema.fields, T.StructField(own, T.LongType())]))
    printed = materialize(printed.withColumn(row, F.monotonically_increasing_id()), "printed")
    prints = printed.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(own).alias("fp"), F.col(row).alias("row"))
    entries = _entries(prints.select("doc_id", "fp"), distance)
    # First the best row of each fingerprint, then of each group: a large group of copies is one row for each task.
    nameless = F.col("doc_id").isNull().alias("nameless")
    best = prints.groupBy("fp").agg(F.min(F.struct(nameless, "doc_id", "row")).alias("b")).join(entries.select("fp", "root"), "fp")
    best = best.groupBy("root").agg(F.min(F.struct("b.nameless", "b.doc_id", "fp", "b.row")).alias("b")).select(F.col("b.row").alias("row"))
    dropped = materialize(prints.select("row").join(best, "row", "left_anti").withColumnRenamed("row", "_dropped"), "dropped-rows")
    return printed.join(dropped, F.col(row) == F.col("_dropped"), "left_anti").select(*docs.columns)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep(docs)
