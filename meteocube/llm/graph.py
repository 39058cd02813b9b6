"""Links between rows: blocks of an inverted list, forests of a block's links, connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meteocube.llm.common import materialize

#: Rows of an inverted list that meet in one block; longer lists are met block by block.
BLOCK = 2048


def list_blocks(postings: DataFrame, key: str, spread: str, block: int = BLOCK) -> DataFrame:
    """Deal every inverted list (rows of one ``key``) into groups of at most about 2 * block rows.

    Any two rows of a list meet in exactly one group (key, lo, hi): a list is cut into m blocks by the
    hash of ``spread``, and every pair of blocks is a group; a row is in its block's m groups. ``side`` is 0
    for rows of block lo and 1 for rows of block hi. Rows alone in their list are left out. However long a
    list is, no task holds more than a group.
    """
    sizes = (
        postings.groupBy(F.col(key).alias("_k"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > 1)
        .select("_k", F.ceil(F.col("_n") / block).cast("int").alias("_m"))
    )
    sizes = materialize(sizes, "list-sizes")  # as a scan, so that AQE can split a hot list's side of the join
    dealt = postings.join(sizes, F.col(key) == F.col("_k")).drop("_k")
    dealt = dealt.withColumn("_own", F.pmod(F.xxhash64(spread, F.lit(7)), F.col("_m")).cast("int"))
    dealt = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_m") - 1)))
    return dealt.select(
        *postings.columns,
        F.least("_own", "_other").alias("lo"),
        F.greatest("_own", "_other").alias("hi"),
        (F.col("_own") > F.col("_other")).cast("int").alias("side"),
    )


def over_groups(groups: DataFrame, key: str, one: Callable[[dict[str, np.ndarray | pa.Array], np.ndarray], pa.RecordBatch], schema: str, rows: int = 65536) -> DataFrame:
    """Apply ``one`` to runs of whole groups (key, lo, hi).

    ``one`` gets the columns of about ``rows`` rows and the bounds of the groups in them. Groups are sorted
    within their partition and streamed, so memory holds one run and not a partition.
    """
    order = [key, "lo", "hi"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def run(t: pa.Table) -> pa.RecordBatch:
            return one(t, _bounds(t, order))

        held: list[pa.RecordBatch] = []
        n = 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= rows:
                whole = pa.Table.from_batches(held).combine_chunks()
                cut = int(_bounds(whole, order)[-2])  # the last group may go on in the next batch
                if cut:
                    yield run(whole.slice(0, cut).combine_chunks())
                held = whole.slice(cut).combine_chunks().to_batches()
                n = whole.num_rows - cut
        if n:
            yield run(pa.Table.from_batches(held).combine_chunks())

    return groups.repartition(*order).sortWithinPartitions(*order).mapInArrow(task, schema)


def _bounds(t: pa.Table, order: list[str]) -> np.ndarray:
    new = np.zeros(t.num_rows, bool)
    new[:1] = True
    for c in order:
        v = t.column(c).to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return np.append(np.flatnonzero(new), t.num_rows)


def pairs_in_groups(bounds: np.ndarray, lo: np.ndarray, hi: np.ndarray, side: np.ndarray, at_once: int = 1 << 21) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Every pair of rows that meets in its group: any two rows of a block with itself, else one of either side."""
    sizes = np.diff(bounds)
    todo = sizes * (sizes - 1) // 2
    at = 0
    while at < len(sizes):
        to = max(at + 1, int(np.searchsorted(np.cumsum(todo[at:]), at_once, side="right")) + at)
        starts, n = bounds[at:to], sizes[at:to]
        first = np.arange(bounds[at], bounds[to])
        left = np.repeat(starts + n, n) - first - 1  # rows after this one in its group
        i = np.repeat(first, left)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(left) - left, left)
        meet = (lo[i] == hi[i]) | (side[i] != side[j])
        yield i[meet], j[meet]
        at = to


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For rows 0..n-1 the smallest row reachable by links (i, j)."""
    root = np.arange(n)
    while True:
        before = root.copy()
        low = np.minimum(root[i], root[j])
        np.minimum.at(root, root[i], low)
        np.minimum.at(root, root[j], low)
        root = root[root]
        if (root == before).all():
            return root


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a long, b long): root is the smallest node reachable.

    Each round hooks every node to its smallest neighbour, jumps twice along the hooks and contracts the
    links, so every component at least halves; rounds are written to the shared folder. All steps are
    aggregates with map-side partial minima and equi-joins (AQE splits a hot node's links).
    """
    edges = links.where(F.col("a") != F.col("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    edges = materialize(edges, "links")
    label: DataFrame | None = None
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        hook = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("to"))
        hook = materialize(hook, "hooks")
        for _ in range(2):
            nxt = hook.select(F.col("node").alias("to"), F.col("to").alias("far"))
            hook = hook.join(nxt, "to").select("node", F.col("far").alias("to"))
        hook = materialize(hook, "jumps")
        if label is None:
            label = hook.select("node", F.col("to").alias("root"))
        else:
            step = hook.select(F.col("node").alias("root"), "to")
            label = materialize(label.join(step, "root", "left").select("node", F.coalesce("to", "root").alias("root")), "labels")
        ends = hook.select(F.col("node").alias("a"), F.col("to").alias("x"))
        edges = edges.join(ends, "a").select(F.col("x").alias("p"), "b")
        edges = edges.join(hook.select(F.col("node").alias("b"), F.col("to").alias("q")), "b").where("p <> q")
        edges = materialize(edges.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct(), "links")
    if label is None:
        return links.sparkSession.createDataFrame([], "node long, root long")
    return label
