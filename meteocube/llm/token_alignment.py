"""Cross-tokenizer alignment: tokens of a byte-level BPE (A) and a sentencepiece BPE (B) of space+text, linked where their bytes overlap.

Inverted pair bitmaps. Documents are numbered inside chunks (part of an input partition). A chunk's links become postings, one row
for each (A id, B id): the numbers of its documents as a compressed bitmap (sorted 16-bit numbers, or bits where that is shorter) and,
where the pair is linked more than once in some document, multiplicity planes: bit k of the link counts of the posting's documents.
OR-merging the bitmaps of a task's slices gives the chunk's bitmap; chunks are disjoint, so the popcount of the OR over all chunks
is the sum of their popcounts, which is all that is shuffled to count the documents of a pair. The pair's count, and whether it is
the highest of its A id, then goes back to the chunks by way of the postings, where planes times counts add up to each document's sums.

A hot pair is one row for each chunk. A group is one chunk, bounded by ``CHUNK_TEXT`` of text (or one longer document).

Defined results: texts that are null, empty, or whose joined A or B bytes differ from space+text have no tokens: zeros and an empty
digest; strings of special tokens inside texts are plain text; repeated rows are documents of their own and count each; a null
doc_id keeps its row; ties for the highest count are all best; an empty table gives no rows; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meteocube.llm.bpe_tree import token_bytes
from meteocube.llm.bulk_bpe import byte_texts, piece_words
from meteocube.llm.common import materialize, table, text_slices
from meteocube.llm.tokens import BYTE_BPE, gather, ragged_binary, ragged_ids, vocabulary

PIECE_BPE = "piece_bpe_32k.model"
CHUNK_TEXT = 16 << 20
CHUNK_DOCS = 1 << 16

DOCS = "chunk long, doc int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
POSTINGS = "pair long, n_docs int, docs binary, planes binary"


# --- tokens and their bytes ---


@functools.lru_cache(maxsize=2)
def _plain(path: str):
    """The tokenizer that reads special tokens' strings as plain text."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    t.encode_special_tokens = True
    return lambda text: np.array(t.encode(text, add_special_tokens=False).ids, np.uint32)


@functools.lru_cache(maxsize=2)
def piece_bytes(path: str) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of every piece, flat, and bounds: U+2581 is a space, <0xHH> the byte HH."""
    sp = piece_words(path).sp
    pieces = [bytes([int(sp.id_to_piece(k)[3:5], 16)]) if sp.is_byte(k) else sp.id_to_piece(k).replace("▁", " ").encode() for k in range(sp.get_piece_size())]
    return np.frombuffer(b"".join(pieces), np.uint8), np.concatenate([[0], np.cumsum([len(p) for p in pieces])])


@functools.lru_cache(maxsize=1)
def _numbers() -> tuple[np.ndarray, np.ndarray]:
    """Decimal text of every 16-bit number, followed by nothing, a comma, a bar or a semicolon: flat, and bounds."""
    texts = [f"{k}{end}".encode() for end in ("", ",", "|", ";") for k in range(1 << 16)]
    return np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in texts])])


@dataclass
class Aligned:
    """Tokens of n texts, their groups, and the links as (A token, B token) places."""

    a: np.ndarray
    a_bounds: np.ndarray
    b: np.ndarray
    b_bounds: np.ndarray
    a_cut: np.ndarray  # the A token ends where a B token ends
    b_cut: np.ndarray
    first: np.ndarray  # of each A token: the first B token that overlaps it, and how many do
    links: np.ndarray

    def pairs(self) -> np.ndarray:
        """A id << 16 | B id of every link, in A's order."""
        n = self.links
        at = np.arange(n.sum()) + np.repeat(self.first - np.cumsum(n) + n, n)
        return np.repeat(self.a.astype(np.uint64) << np.uint64(16), n) | self.b[at].astype(np.uint64)

    def per_text(self, value: np.ndarray) -> np.ndarray:
        """Sum over each text of a value of its A tokens."""
        return np.diff(np.concatenate([[0], np.cumsum(value)])[self.a_bounds])

    def digests(self, block: int = 1 << 18) -> list[str]:
        """Per text the SHA-256 of its groups as text: ids by commas, sides by bars, groups by semicolons; '' without tokens."""
        a_ends, b_ends = np.flatnonzero(self.a_cut) + 1, np.flatnonzero(self.b_cut) + 1
        entry = np.empty(len(self.a) + len(self.b), np.int64)
        b_before = np.concatenate([[0], b_ends])[np.cumsum(self.a_cut) - self.a_cut]
        entry[np.arange(len(self.a)) + b_before] = self.a + (np.where(self.a_cut, 2, 1) << 16)
        b_end = np.where(self.b_cut, 3, 1)
        b_end[self.b_bounds[1:][np.diff(self.b_bounds) > 0] - 1] = 0
        if len(self.b):
            entry[np.arange(len(self.b)) + a_ends[np.cumsum(self.b_cut) - self.b_cut]] = self.b + (b_end << 16)
        parts, sizes = [], [np.zeros(1, np.int64)]
        for at in range(0, len(entry), block):
            raw, ends = gather(*_numbers(), entry[at : at + block])
            parts.append(raw.tobytes())
            sizes.append(np.diff(ends))
        whole, ends = memoryview(b"".join(parts)), np.cumsum(np.concatenate(sizes))[self.a_bounds + self.b_bounds]
        return [hashlib.sha256(whole[x:y]).hexdigest() if y > x else "" for x, y in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


def _equals(text_bytes: np.ndarray, bounds: np.ndarray, ids: np.ndarray, id_bounds: np.ndarray, pool: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Which texts are their tokens' bytes joined."""
    joined, ends = gather(*pool, ids.astype(np.int64))
    ends = ends[id_bounds]
    same = np.diff(ends) == np.diff(bounds)
    if same.all() and np.array_equal(joined, text_bytes):
        return same
    for k in np.flatnonzero(same):
        same[k] = np.array_equal(joined[ends[k] : ends[k + 1]], text_bytes[bounds[k] : bounds[k + 1]])
    return same


def _only(ids: np.ndarray, bounds: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = np.diff(bounds)
    return ids[np.repeat(keep, n)].astype(np.int64), np.concatenate([[0], np.cumsum(np.where(keep, n, 0))])


def align(text: pa.Array, a_path: str, b_path: str) -> Aligned:
    """Align every text (large strings without nulls)."""
    a, a_bounds = byte_texts(a_path, text, " ", _plain(a_path))
    b, b_bounds = piece_words(b_path).texts(text)
    a_pool, b_pool = token_bytes(a_path), piece_bytes(b_path)
    led = pc.binary_join_element_wise(pa.scalar("", pa.large_string()), text, pa.scalar(" ", pa.large_string()))
    bounds = np.frombuffer(led.buffers()[1], np.int64)[led.offset : led.offset + len(led) + 1] if len(led) else np.zeros(1, np.int64)
    raw = np.frombuffer(led.buffers()[2], np.uint8)[bounds[0] : bounds[-1]] if len(led) else np.zeros(0, np.uint8)
    bounds = bounds - bounds[0]
    good = (np.diff(bounds) > 1) & _equals(raw, bounds, a, a_bounds, a_pool) & _equals(raw, bounds, b, b_bounds, b_pool)
    a, a_bounds = _only(a, a_bounds, good)
    b, b_bounds = _only(b, b_bounds, good)
    # Both sides of a good text have its bytes, so places in the joined good texts serve for all of them at once.
    a_size, b_size = np.diff(a_pool[1])[a], np.diff(b_pool[1])[b]
    a_end, b_end = np.cumsum(a_size), np.cumsum(b_size)
    a_cut = b_end[np.searchsorted(b_end, a_end)] == a_end if len(a) else np.zeros(0, bool)
    b_cut = a_end[np.searchsorted(a_end, b_end)] == b_end if len(b) else np.zeros(0, bool)
    first = np.searchsorted(b_end, a_end - a_size, side="right")
    return Aligned(a, a_bounds, b, b_bounds, a_cut, b_cut, first, np.searchsorted(b_end - b_size, a_end) - first)


# --- postings ---


def posting_rows(keys: np.ndarray, n_docs: int) -> dict[str, pa.Array]:
    """Postings of links given as (pair << 16 | document), one for each link, of documents 0 .. n_docs - 1."""
    keys = np.sort(keys)
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    times = np.diff(np.append(new, len(keys)))
    keys = keys[new]
    pair, doc = (keys >> np.uint64(16)).astype(np.int64), (keys & np.uint64(0xFFFF)).astype("<u2")
    at = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]])) if len(pair) else np.zeros(0, np.int64)
    bounds = np.append(at, len(pair))
    size = np.diff(bounds)
    row = np.repeat(np.arange(len(at)), size)
    # Bitmaps where they are shorter than the sorted numbers.
    width = -(-n_docs // 8)
    dense = size * 2 > width
    lengths = np.where(dense, width, size * 2)
    out = np.zeros(lengths.sum(), np.uint8)
    starts = np.cumsum(lengths) - lengths
    listed = ~dense[row]
    place = (starts[row] + 2 * (np.arange(len(doc)) - bounds[row]))[listed]
    out[place], out[place + 1] = doc[listed] & 0xFF, doc[listed] >> 8
    bit = doc[~listed].astype(np.int64)
    np.bitwise_or.at(out, starts[row[~listed]] + bit // 8, (1 << (bit % 8)).astype(np.uint8))
    # Planes: plane k holds bit k of every link count, in the order of the documents.
    most = np.maximum.reduceat(times, at) if len(at) else np.zeros(0, np.int64)
    n_planes = np.where(most > 1, np.floor(np.log2(np.maximum(most, 1))).astype(np.int64) + 1, 0)
    plane = -(-size // 8)
    plane_bounds = np.concatenate([[0], np.cumsum(n_planes * plane)])
    bits = np.zeros(plane_bounds[-1] * 8, bool)
    for k in range(int(n_planes.max(initial=0))):
        here = (n_planes[row] > k) & (times >> k & 1 > 0)
        r = row[here]
        bits[8 * (plane_bounds[r] + k * plane[r]) + np.flatnonzero(here) - bounds[r]] = True
    return {
        "pair": pa.array(pair[at]), "n_docs": pa.array(size.astype(np.int32)), "docs": ragged_binary(out, np.concatenate([[0], np.cumsum(lengths)]), "u1"),
        "planes": ragged_binary(np.packbits(bits, bitorder="little"), plane_bounds, "u1"),
    }


def posting_links(rows: pa.Table, n_docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, document, links) of every posting's documents: the inverse of ``posting_rows``."""
    size = rows["n_docs"].to_numpy().astype(np.int64)
    raw, bounds = ragged_ids(_one(rows["docs"]), "u1")
    dense = np.diff(bounds) != size * 2
    row = np.repeat(np.arange(len(size)), size)
    starts = np.cumsum(size) - size
    doc = np.empty(len(row), np.int64)
    listed = ~dense[row]
    place = (bounds[:-1][row] + 2 * (np.arange(len(row)) - starts[row]))[listed]
    doc[listed] = raw[place].astype(np.int64) | raw[place + 1].astype(np.int64) << 8
    for k in np.flatnonzero(dense):
        doc[starts[k] : starts[k] + size[k]] = np.flatnonzero(np.unpackbits(raw[bounds[k] : bounds[k + 1]], bitorder="little", count=n_docs))
    data, ends = ragged_ids(_one(rows["planes"]), "u1")
    bits = np.unpackbits(data, bitorder="little")
    plane = -(-size // 8)
    n_planes = np.diff(ends) // np.maximum(plane, 1)
    links = np.where(n_planes[row] > 0, 0, 1)
    for k in range(int(n_planes.max(initial=0))):
        at = np.flatnonzero(n_planes[row] > k)
        r = row[at]
        links[at] += bits[8 * (ends[r] + k * plane[r]) + at - starts[r]].astype(np.int64) << k
    return row, doc, links


def _one(column: pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)


# --- the corpus ---


def index(docs: DataFrame, a_path: str, b_path: str, chunk_docs: int = CHUNK_DOCS) -> DataFrame:
    """Rows of DOCS (``pair`` null) and of POSTINGS (``doc`` null) of every chunk."""
    if not 1 <= chunk_docs <= CHUNK_DOCS:
        raise ValueError(f"a chunk holds from 1 to {CHUNK_DOCS} documents")
    schema = f"{DOCS}, {POSTINGS}, chunk_docs int"
    fields = [f.split() for f in schema.split(", ")]
    types = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, chunk, keys, n_docs, size = TaskContext.get().partitionId(), 0, [], 0, 0

        def rows(n: int, columns: dict) -> pa.RecordBatch:
            columns["chunk"] = pa.array(np.full(n, part << 32 | chunk))
            return pa.RecordBatch.from_arrays([columns[f].cast(types[t]) if f in columns else pa.nulls(n, types[t]) for f, t in fields], names=[f for f, _ in fields])

        def close() -> pa.RecordBatch:
            nonlocal chunk, keys, n_docs, size
            made = posting_rows(np.concatenate(keys), n_docs)
            made["chunk_docs"] = pa.array(np.full(len(made["pair"]), n_docs))
            out = rows(len(made["pair"]), made)
            chunk, keys, n_docs, size = chunk + 1, [], 0, 0
            return out

        for batch in batches:
            for at in range(0, batch.num_rows, chunk_docs):
                for part_rows, text in text_slices(iter([batch.slice(at, chunk_docs)]), "text"):
                    if keys and (n_docs + len(text) > chunk_docs or size >= CHUNK_TEXT):
                        yield close()
                    found = align(text, a_path, b_path)
                    n = len(text)
                    links = found.per_text(found.links)
                    doc = n_docs + np.repeat(np.arange(n), links)
                    keys.append(found.pairs() << np.uint64(16) | doc.astype(np.uint64))
                    yield rows(n, {
                        "doc": pa.array(n_docs + np.arange(n)), "doc_id": part_rows.column(0), "n_a": pa.array(np.diff(found.a_bounds)), "n_b": pa.array(np.diff(found.b_bounds)),
                        "n_groups": pa.array(found.per_text(found.a_cut)), "n_links": pa.array(links), "groups_sha256": pa.array(found.digests(), pa.string()),
                    })
                    n_docs, size = n_docs + n, size + (pc.sum(pc.binary_length(text)).as_py() or 0)
        if keys:
            yield close()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(task, schema)


def pair_counts(postings: DataFrame) -> DataFrame:
    """(pair, count, best) of every linked pair: documents that hold it linked, and whether no pair of its A id has more."""
    counts = postings.groupBy("pair").agg(F.sum("n_docs").cast("long").alias("count"))
    # The pairs of one A id: at most the size of B's vocabulary.
    highest = F.max("count").over(W.partitionBy(F.shiftright("pair", 16)))
    return counts.withColumn("best", F.col("count") == highest)


def document_sums(scored: DataFrame) -> DataFrame:
    """(chunk, doc, n_best, count_sum) from postings with their pair's count and best."""

    def one(t: pa.Table) -> pa.Table:
        n = t["chunk_docs"][0].as_py()
        row, doc, links = posting_links(t, n)
        best, total = np.zeros(n, np.int64), np.zeros(n, np.int64)
        np.add.at(best, doc, links * t["best"].to_numpy().astype(np.int64)[row])
        np.add.at(total, doc, links * t["count"].to_numpy()[row])
        some = np.flatnonzero(total)
        return pa.table({"chunk": pa.array(np.full(len(some), t["chunk"][0].as_py())), "doc": pa.array(some.astype(np.int32)), "n_best": pa.array(best[some]), "count_sum": pa.array(total[some])})

    return scored.groupBy("chunk").applyInArrow(one, "chunk long, doc int, n_best long, count_sum long")


def align_documents(docs: DataFrame, a_path: str, b_path: str, chunk_docs: int = CHUNK_DOCS) -> tuple[DataFrame, DataFrame]:
    """Per document its alignment and link sums; and (a, b, count, best) of every linked id pair of the corpus."""
    made = materialize(index(docs, a_path, b_path, chunk_docs), "token-links")
    postings = made.where(F.col("pair").isNotNull()).select("chunk", "chunk_docs", *[f.split()[0] for f in POSTINGS.split(", ")])
    pairs = pair_counts(postings)
    sums = document_sums(postings.join(pairs, "pair"))
    kept = made.where(F.col("doc").isNotNull()).select(*[f.split()[0] for f in DOCS.split(", ")])
    zero = F.lit(0).cast("long")
    out = kept.join(sums, ["chunk", "doc"], "left").select("doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")
    return out, pairs.select(F.shiftright("pair", 16).alias("a"), F.col("pair").bitwiseAND(0xFFFF).alias("b"), "count", "best")


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_documents(table(spark, sf_dir, "documents"), vocabulary(BYTE_BPE), vocabulary(PIECE_BPE))[0]
