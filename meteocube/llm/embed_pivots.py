"""Embedding near-dedup: a pivot-permutation index.

Every vector is described by its nearest reference points (pivots) in order, more of them the more pivots there are. An inverted list per
pivot holds the vectors that name it; two vectors that share at least ``shared`` pivots are candidates, and a
candidate pair is a link when its cosine, in double precision, is ``threshold`` or more.

Scale: equal vectors are one entry with a count. The number of pivots grows with the square root of the
number of entries (up to ``MAX_PIVOTS``), so lists and assignment both cost about n ** 1.5; among more pivots two near
vectors share fewer of their first few, so the prefix grows too (``prefix_length``). Pivots are numbered from the rarest on.
Two vectors that share ``shared`` of their k pivots have one in common among the k - shared + 1 rarest of either, so an
entry is in those lists alone, and a pair counts in the list of its smallest shared number. A list is met in blocks
(``graph.list_blocks``), whatever its length: shared pivots are counted block against block.

Postings carry no vectors but a byte per component, with the exact length of what rounding took away. That bounds the
error of a cosine: pairs above or below the threshold by more are decided at once, the others are *unsure*. A second
round takes only the entries with an unsure pair, once per block, with their whole vectors, and decides those pairs
in double precision. A block returns for each entry its number of links and one representative, never the pairs.

Defined results: a vector that is null, empty, zero, or holds a null or non-finite component links with nothing
(n_links 0, its own component); shorter vectors are read as padded with zeros to the longest; repeated rows are
other vectors and link; a null vec_id takes part with its vector, cannot name a component, and is never kept;
an empty table gives an empty result; only ``vec_id`` and ``embedding`` are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from meteocube.llm.common import materialize, table
from meteocube.llm.graph import components, forest, list_blocks, over_groups

MAX_PIVOTS = 16384
#: Numbers that a task compares at once; bounds memory only.
CELLS = 1 << 22
#: What a block returns: links of an entry (pivot null), or an entry of an unsure pair.
MET = "rid long, to long, n_links long, pivot int, lo int, hi int, side int"


@dataclass(frozen=True)
class Settings:
    threshold: float = 0.9
    #: nearest pivots that describe a vector at least (``prefix_length``), and how many two vectors must share
    prefix: int = 8
    shared: int = 3
    #: pivots = this * sqrt(entries), a power of two between 16 and MAX_PIVOTS
    pivots_per_root: float = 2.0
    #: a pivot is dropped when it is closer than this cosine to one before it
    apart: float = 0.8
    block: int = 4096
    seed: int = 11


def pivot_count(entries: int, s: Settings) -> int:
    return int(min(MAX_PIVOTS, max(16, 2 ** round(np.log2(max(1.0, s.pivots_per_root * np.sqrt(entries)))))))


def prefix_length(pivots: int, s: Settings) -> int:
    """How many nearest of that many pivots describe a vector: one more for each doubling, so that recall holds."""
    return max(s.prefix, int(np.ceil(np.log2(max(1, pivots)))) + 3)


def choose_pivots(sample: np.ndarray, count: int, apart: float, at_once: int = 256) -> np.ndarray:
    """The first ``count`` unit vectors of the sample that are not close to a chosen one."""
    chosen = np.empty((min(count, len(sample)), sample.shape[1]))
    n = 0
    for at in range(0, len(sample), at_once):
        part = sample[at : at + at_once]
        if n:
            part = part[(part @ chosen[:n].T).max(axis=1) < apart]
        near = part @ part.T >= apart
        taken: list[int] = []
        for k in range(len(part)):
            if n + len(taken) < count and not near[k, taken].any():
                taken.append(k)
        chosen[n : n + len(taken)] = part[taken]
        n += len(taken)
        if n == count:
            break
    return chosen[:n]


def _packed_vectors(vectors: DataFrame) -> tuple[DataFrame, np.dtype]:
    """(vec_id, vec) and the type of a component: components packed as they are stored (floats or doubles), null for vectors that link with nothing."""
    kind = "float" if vectors.schema["embedding"].dataType == ArrayType(FloatType()) else "double"
    size = F.size("embedding")
    parts = F.transform("embedding", lambda x: x.cast(kind))
    usable = F.forall(parts, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))) & F.exists(parts, lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("long"), F.when((size > 0) & usable, parts).alias("embedding"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            flat = lists.flatten().to_numpy(zero_copy_only=False) + np.float32(0)  # -0.0 becomes 0.0
            bounds = np.concatenate([[0], np.cumsum(np.diff(lists.offsets.to_numpy()))]) if len(lists) else [0]
            valid = lists.is_valid().to_numpy(zero_copy_only=False)
            packed = [np.trim_zeros(flat[a:b], "b").tobytes() if ok else None for a, b, ok in zip(bounds[:-1], bounds[1:], valid, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], names=["vec_id", "vec"])

    return rows.mapInArrow(task, "vec_id long, vec binary"), np.dtype(kind if kind == "double" else "float32")


def _matrix(vecs: list[bytes], dim: int, kind: np.dtype) -> np.ndarray:
    """Unit vectors in double precision."""
    out = np.zeros((len(vecs), dim))
    for k, v in enumerate(vecs):
        x = np.frombuffer(v, kind)
        out[k, : len(x)] = x
    # The scale does not matter to a cosine; dividing by the largest component keeps squares finite.
    out /= np.abs(out).max(axis=1, keepdims=True)
    return out / np.sqrt((out * out).sum(axis=1, keepdims=True))


def _permutations(x: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """The nearest pivots of each unit vector, nearest first; at most ``CELLS`` similarities at once."""
    k = min(prefix, len(pivots))
    out = np.empty((len(x), k), np.int64)
    step = max(1, CELLS // len(pivots))
    for at in range(0, len(x), step):
        near = x[at : at + step] @ pivots.T
        best = np.sort(np.argpartition(near, len(pivots) - k, axis=1)[:, len(pivots) - k :], axis=1)
        order = np.argsort(-np.take_along_axis(near, best, axis=1), axis=1, kind="stable")
        out[at : at + step] = np.take_along_axis(best, order, axis=1)
    return out


def _codes(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit vectors as (signed bytes, their scale, the length of what rounding took away, rounded up)."""
    scale = (np.abs(x).max(axis=1) / 127).astype(np.float32)
    code = np.rint(x / scale[:, None]).clip(-127, 127).astype(np.int8)
    lost = x - code * scale[:, None].astype(np.float64)
    lost = np.sqrt((lost * lost).sum(axis=1)).astype(np.float32)
    return code, scale, np.nextafter(lost, np.float32(2))


def links(vectors: DataFrame, s: Settings = Settings()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows: vec_id, vec, key; entries: rid, vec, key, n, low_id; found: rid, to, n_links).

    ``found`` has for every entry with links its links in one block (vectors, copies counted) and an entry of
    the same component. ``key`` is the vector's SHA-256, so that joins of rows with their entries carry no vectors.
    """
    spark = vectors.sparkSession
    rows, kind = _packed_vectors(vectors)
    rows = materialize(rows.withColumn("key", F.unhex(F.sha2("vec", 256))), "vectors")
    entries = rows.where("vec is not null").groupBy("vec").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("low_id"))
    entries = entries.select(F.monotonically_increasing_id().alias("rid"), "vec", F.unhex(F.sha2("vec", 256)).alias("key"), "n", "low_id")
    entries = materialize(entries, "entries")
    total, longest = entries.agg(F.count(F.lit(1)), F.max(F.length("vec"))).first()
    if not total:
        return rows, entries, spark.createDataFrame([], "rid long, to long, n_links long")
    dim = int(longest) // kind.itemsize
    want = pivot_count(total, s)
    sample = entries.orderBy(F.xxhash64("vec", F.lit(s.seed)), "vec").limit(2 * want).select("vec").collect()  # at most 2 * MAX_PIVOTS vectors
    pivots = choose_pivots(_matrix([bytes(r.vec) for r in sample], dim, kind), want, s.apart).astype(np.float32)
    prefix = prefix_length(len(pivots), s)
    described = materialize(_described(entries, pivots, prefix, dim, kind), "described")
    uses = described.select(F.explode("perm").alias("pivot")).groupBy("pivot").count().collect()  # at most MAX_PIVOTS rows
    number = np.zeros(len(pivots), np.int16)
    number[[r.pivot for r in sorted(uses, key=lambda r: (r["count"], r.pivot))]] = np.arange(len(uses))
    shared = min(s.shared, prefix, len(pivots))
    postings = materialize(_postings(described, number, shared), "postings")

    groups = list_blocks(postings, "pivot", "rid", s.block)
    first = over_groups(groups, "pivot", _meeting(s.threshold, shared, dim, None), MET, rows=2 * s.block)
    first = materialize(first, "vector-links")
    unsure = first.where("pivot is not null").select("pivot", "lo", "hi", "side", "rid")
    again = unsure.join(postings.select("pivot", "rid", "n", "perm", "code"), ["pivot", "rid"]).join(entries.select("rid", "vec"), "rid")
    second = over_groups(again, "pivot", _meeting(s.threshold, shared, dim, kind), MET, rows=2 * s.block)
    second = materialize(second, "unsure-links")
    found = first.where("pivot is null").union(second).select("rid", "to", "n_links")
    return rows, entries, found


def _described(entries: DataFrame, pivots: np.ndarray, prefix: int, dim: int, kind: np.dtype) -> DataFrame:
    """(rid, n, perm, code): pivots nearest first; the vector in bytes, behind its scale and error."""
    held = entries.sparkSession.sparkContext.broadcast(pivots)  # at most MAX_PIVOTS vectors

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                x = _matrix(part.column(2).to_pylist(), dim, kind)
                perm = _permutations(x.astype(np.float32), held.value, prefix)
                code, scale, lost = _codes(x)
                packed = [a.tobytes() + c.tobytes() for a, c in zip(np.stack([scale, lost], axis=1), code, strict=True)]
                ends = pa.array(np.arange(len(perm) + 1, dtype=np.int32) * perm.shape[1])
                lists = pa.ListArray.from_arrays(ends, pa.array(perm.ravel().astype(np.int32)))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), lists, pa.array(packed, pa.binary())], names=["rid", "n", "perm", "code"])

    return entries.select("rid", "n", "vec").mapInArrow(task, "rid long, n long, perm array<int>, code binary")


def _postings(described: DataFrame, number: np.ndarray, shared: int) -> DataFrame:
    """(pivot, rid, n, perm, code): an entry in the lists of its rarest pivots; pivots by number, rarest first."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            perm = np.sort(number[batch.column(2).flatten().to_numpy().reshape(batch.num_rows, -1)], axis=1)
            lists = perm[:, : perm.shape[1] - shared + 1]
            row = pa.array(np.repeat(np.arange(len(perm)), lists.shape[1]))
            packed = pa.array([p.tobytes() for p in perm], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(lists.ravel().astype(np.int32)), batch.column(0).take(row), batch.column(1).take(row), packed.take(row), batch.column(3).take(row)],
                names=["pivot", "rid", "n", "perm", "code"],
            )

    return described.mapInArrow(task, "pivot int, rid long, n long, perm binary, code binary")


def _meeting(threshold: float, shared: int, dim: int, kind: np.dtype | None) -> Callable[[pa.Table, np.ndarray], pa.RecordBatch]:
    """What ``over_groups`` does with its groups: links that the bytes decide and entries of unsure pairs, or,
    given the ``kind`` of whole vectors, the links among unsure pairs."""

    def meet(t: pa.Table, bounds: np.ndarray) -> pa.RecordBatch:
        rid, n, pivot, lo, hi, side = (t.column(c).to_numpy() for c in ("rid", "n", "pivot", "lo", "hi", "side"))
        ids, to, many, doubt = [], [], [], []
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            left, right, sure, unsure = _compare(t, a, b, lo[a] == hi[a], side[a:b], int(pivot[a]), threshold, shared, dim)
            i, j = np.nonzero(unsure)
            if kind is None:
                doubt.append(a + np.unique(np.concatenate([left[i], right[j]])))
                i, j = np.nonzero(sure)
            i, j = left[i], right[j]
            if kind is not None and len(i):
                x = _matrix(t.column("vec").slice(a, b - a).to_pylist(), dim, kind)
                step = max(1, CELLS // dim)
                close = [np.einsum("ij,ij->i", x[i[c : c + step]], x[j[c : c + step]]) >= threshold for c in range(0, len(i), step)]
                close = np.concatenate(close)
                i, j = i[close], j[close]
            if not len(i):
                continue
            size = b - a
            count = np.bincount(i, weights=n[a:b][j], minlength=size) + np.bincount(j, weights=n[a:b][i], minlength=size)
            root = forest(size, i, j)
            has = np.flatnonzero(count)
            ids.append(rid[a:b][has])
            to.append(rid[a:b][root[has]])
            many.append(count[has].astype(np.int64))
        whole = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
        at = whole(doubt)
        linked, none = whole(ids), np.zeros(len(at), np.int64)
        blank = lambda v: pa.concat_arrays([pa.nulls(len(linked), pa.int32()), pa.array(v[at].astype(np.int32))])
        columns = [pa.array(np.concatenate(x)) for x in ((linked, rid[at]), (whole(to), none), (whole(many), none))]
        return pa.RecordBatch.from_arrays([*columns, *map(blank, (pivot, lo, hi, side))], names=["rid", "to", "n_links", "pivot", "lo", "hi", "side"])

    return meet


def _compare(
    t: pa.Table, a: int, b: int, own: bool, side: np.ndarray, pivot: int, threshold: float, shared: int, dim: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(left, right, sure, unsure): rows of group a..b and which pairs of them the bytes show to link, or leave open.

    Pairs share enough pivots, and the smallest number they share is this list's.
    """
    left = np.arange(b - a) if own else np.flatnonzero(side == 0)
    right = left if own else np.flatnonzero(side == 1)
    perm = np.stack([np.frombuffer(p, np.int16) for p in t.column("perm").slice(a, b - a).to_pylist()])
    meets = _candidates(perm, left, right, pivot, shared)
    if own:
        meets &= ~np.tri(len(left), dtype=bool)
    raw = t.column("code").slice(a, b - a).to_pylist()
    scale, lost = np.stack([np.frombuffer(c, np.float32, 2) for c in raw]).T
    # Sums of products of bytes are exact here, and what follows is the same for (x, y) and (y, x): both rounds judge a pair alike.
    whole = np.float32 if dim * 127**2 < 2**24 else np.float64
    x = np.stack([np.frombuffer(c, np.int8, offset=8) for c in raw]).astype(whole)
    cosine = (x[left] @ x[right].T).astype(np.float32) * (scale[left][:, None] * scale[right][None])
    # |xy - x'y'| <= |x - x'| + |y - y'| + |x - x'| |y - y'|, and a margin for the last steps in single precision
    off = lost[left][:, None] + lost[right][None] + lost[left][:, None] * lost[right][None] + np.float32(2.0**-20)
    sure = meets & (cosine - off >= threshold)
    return left, right, sure, meets & ~sure & (cosine + off >= threshold)


def _candidates(perm: np.ndarray, left: np.ndarray, right: np.ndarray, pivot: int, shared: int, at_once: int = 1024) -> np.ndarray:
    """Which pairs (left, right) share enough pivots, with this list's the smallest of them.

    Pivots are tallied ``at_once`` at a time, so memory is bounded by the block and not by the number of pivots.
    """
    different, place = np.unique(perm, return_inverse=True)
    place = place.reshape(perm.shape)
    tally = np.zeros((len(left), len(right)), np.float32)
    before = int(np.searchsorted(different, pivot))
    meets = np.ones(tally.shape, bool)
    for first, last in ((0, before), (before, len(different))):
        for at in range(first, last, at_once):
            to = min(at + at_once, last)
            row, col = np.nonzero((place >= at) & (place < to))
            named = np.zeros((len(perm), to - at), np.float32)
            named[row, place[row, col] - at] = 1
            tally += named[left] @ named[right].T
        if last == before:
            meets = tally == 0
    return meets & (tally >= shared)


def near_duplicates(vectors: DataFrame, s: Settings = Settings()) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    rows, entries, found = links(vectors, s)
    root = components(found.select(F.col("rid").alias("a"), F.col("to").alias("b")))
    degree = found.groupBy("rid").agg(F.sum("n_links").alias("links"))
    known = entries.join(degree, "rid", "left").join(root.withColumnRenamed("node", "rid"), "rid", "left")
    known = materialize(known.select("key", "low_id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("root", "rid").alias("root")), "entry-roots")
    low = materialize(known.groupBy("root").agg(F.min("low_id").alias("component_id")), "component-ids")
    known = materialize(known.join(low, "root").select("key", "n_links", "component_id"), "entry-components")
    out = rows.join(known, "key", "left")
    own = F.coalesce("component_id", "vec_id")
    own = F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(own)
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"), F.coalesce(F.col("vec_id") == own, F.lit(False)).alias("kept"))


def op2_embed_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
