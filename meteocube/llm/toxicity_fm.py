"""Toxicity: a factorization machine over hashed terms.

Terms of a text are its words (lower case, without punctuation around them) and their first four and five
characters, hashed to 2^``Settings.bits`` buckets. score = sigmoid(w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j) over
the buckets that occur: the pair part learns combinations (an insult together with a group) that no sum of single
weights can tell apart. x_i, the value of a bucket, is g / (g + ``Settings.prior``) with g its log-likelihood ratio against the
label, but at least ``Settings.least``: no term is left out, and chance ones of a long text do not add up to a verdict.

Fitting reads at most ``Settings.sample`` labelled ids of each class (the smallest hashes of their ids; those of
held-out ids never), each with at most ``Settings.texts`` different term sets (an id that repeats, however often). Buckets that
no such text holds have no parameters. Training runs in ``Settings.shards`` tasks, each over its shard, whose parameters are averaged
after every round by chunks, in Spark; parameters are a table of at most 2^bits rows, of which the driver holds one copy.

Defined results: a null text is an empty text and gets sigmoid(w0); equal texts get equal scores; without labels
of both classes every score is the mean label (0 without labels); empty tables give an empty result; repeated rows
each give a row; only ``doc_id`` and ``text`` are read, so further columns cannot clash.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meteocube.llm import textstats as ts
from meteocube.llm.common import held_out, materialize, table, text_slices, training_labels

THRESHOLD = 0.5
#: parameters in a chunk that travels by itself
CHUNK = 1 << 14


@dataclass(frozen=True)
class Settings:
    #: rows of each class that fitting reads at most
    sample: int = 12_000
    #: different texts of one labelled id that fitting reads at most
    texts: int = 4
    #: terms are hashed to 2^bits buckets
    bits: int = 16
    #: log-likelihood ratio at which a bucket has half its full value, and the smallest value
    prior: float = 30.0
    least: float = 0.05
    factors: int = 8
    shards: int = 4
    rounds: int = 4
    epochs: int = 4
    rate: float = 0.15
    batch: int = 64
    l2: float = 1e-4
    seed: int = 7


@dataclass
class Model:
    terms: np.ndarray  # sorted buckets
    w0: float
    w: np.ndarray  # weights and factors times the bucket's value
    v: np.ndarray
    bits: int = Settings.bits

    def packed(self) -> bytes:
        """For the tasks that score: factors as bytes of the largest one of their bucket, the rest in half precision (below 1 MB)."""
        top = np.maximum(np.abs(self.v).max(1), 1e-6).astype(np.float16)
        q = np.rint(self.v / np.maximum(top.astype(np.float64), 1e-7)[:, None] * 127).clip(-127, 127).astype(np.int8)
        return zlib.compress(pickle.dumps((self.terms, self.w0, self.w.astype(np.float16), top, q, self.bits)), 1)

    @staticmethod
    def unpacked(data: bytes) -> Model:
        terms, w0, w, top, q, bits = pickle.loads(zlib.decompress(data))
        return Model(terms, w0, w.astype(np.float64), q * (top.astype(np.float64) / 127)[:, None], bits)


def hashed_terms(dictionary: pa.Array, bits: int = Settings.bits) -> np.ndarray:
    """For each word three buckets from 1 to 2^bits: of the word, its first four and its first five characters (0: none)."""
    word = pc.ascii_trim(pc.utf8_lower(dictionary), "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
    length = pc.utf8_length(word).to_numpy(zero_copy_only=False)
    out = np.zeros((len(dictionary), 3), np.uint32)
    if not len(dictionary):
        return out
    for k, (size, seed) in enumerate(((0, 1), (4, 3), (5, 4))):
        # Words share their spelling or their start: each different one is hashed once.
        cut = (pc.utf8_slice_codeunits(word, 0, size) if size else word).dictionary_encode()
        hashed = [1 + (xxhash.xxh32_intdigest(b, seed) >> 32 - bits) for b in cut.dictionary.cast(pa.large_binary()).to_pylist()]
        out[:, k] = np.where(length > size, np.array(hashed, np.uint32)[cut.indices.to_numpy(zero_copy_only=False)], 0)
    return out


def _distinct(values: np.ndarray) -> np.ndarray:
    """The different values, sorted (numpy's own ``unique`` goes through a hash table, which takes many times longer)."""
    values = np.sort(values)
    return values[np.concatenate([values[:1] == values[:1], values[1:] != values[:-1]])]


def _presence(w: ts.Words, terms: np.ndarray) -> np.ndarray:
    """Different (text, bucket) pairs as text << 32 | bucket."""
    pairs = _distinct(w.doc * max(1, len(w.dictionary)) + w.idx)
    doc, word = pairs // max(1, len(w.dictionary)), pairs % max(1, len(w.dictionary))
    found = terms[word]
    doc = np.repeat(doc, terms.shape[1])
    found = found.ravel()
    keep = found != 0
    return _distinct((doc[keep].astype(np.uint64) << np.uint64(32)) | found[keep].astype(np.uint64))


def terms_of_rows(docs: DataFrame, bits: int = Settings.bits) -> DataFrame:
    """(y, row, terms): the different buckets of every text, packed."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, text in text_slices(batches, "text"):
            w = ts.words(text)
            pairs = _presence(w, hashed_terms(w.dictionary, bits))
            bounds = np.searchsorted(pairs, np.arange(len(text) + 1).astype(np.uint64) << np.uint64(32))
            low = (pairs & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            packed = [low[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(packed, pa.binary())], names=["y", "row", "terms"])

    return docs.select("y", "row", "text").mapInArrow(task, "y double, row long, terms binary")


def _values(rows: DataFrame, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of the rows, sorted, and their values, from 0 to 1 by association with the label."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [np.frombuffer(t, np.uint32) for t in batch.column(1).to_pylist()]
            if not parts:
                continue
            flat = np.concatenate(parts)
            y = np.repeat(batch.column(0).to_numpy(), [len(p) for p in parts])
            term, place = np.unique(flat, return_inverse=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(term.astype(np.int64)), pa.array(np.bincount(place, weights=y, minlength=len(term))), pa.array(np.bincount(place, minlength=len(term)).astype(float))],
                names=["term", "a", "n"],
            )

    counts = rows.select("y", "terms").mapInArrow(count, "term long, a double, n double").groupBy("term").agg(F.sum("a").alias("a"), F.sum("n").alias("n"))
    all_n, all_a = rows.agg(F.count("y"), F.sum("y")).first()
    found = counts.toArrow().sort_by("term")  # at most 2^bits rows
    term, positive, n = (found[c].to_numpy() for c in ("term", "a", "n"))
    part = lambda seen, due: np.where(seen > 0, seen * np.log(np.maximum(seen, 0.5) / due), 0.0)
    g = np.maximum(part(positive, n * (all_a / all_n)) + part(n - positive, n * (1 - all_a / all_n)), 0.0)
    return term.astype(np.uint32), np.maximum(g / (g + settings.prior), settings.least)


def _known(packed: list[bytes], terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places in terms, bounds of the rows) of the rows' terms that the model has."""
    parts = [np.frombuffer(t, np.uint32) for t in packed]
    flat = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
    row = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    at = np.searchsorted(terms, flat)
    hit = terms[np.minimum(at, len(terms) - 1)] == flat
    return at[hit], np.searchsorted(row[hit], np.arange(len(parts) + 1))


def margin(places: np.ndarray, bounds: np.ndarray, w0: float, w: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Raw scores of rows of present terms, and the sums of their factors."""
    n = len(bounds) - 1
    row = np.repeat(np.arange(n), np.diff(bounds))
    total = np.column_stack([np.bincount(row, weights=v[places, k], minlength=n) for k in range(v.shape[1])])
    squares = np.bincount(row, weights=(v[places] ** 2).sum(1), minlength=n)
    linear = np.bincount(row, weights=w[places], minlength=n)
    return w0 + linear + 0.5 * ((total**2).sum(1) - squares), total


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def _train(places: np.ndarray, bounds: np.ndarray, y: np.ndarray, weight: np.ndarray, start: np.ndarray, s: Settings, seed: int, value: np.ndarray | None = None) -> np.ndarray:
    """AdaGrad over one shard from the given parameters (w0, w, v in one row), where a term counts with its ``value`` (1)."""
    m = (len(start) - 1) // (1 + s.factors)
    p = start.astype(np.float64)
    w, v = p[1 : 1 + m], p[1 + m :].reshape(m, s.factors)
    seen = np.full(len(p), 1e-3)
    seen_w, seen_v = seen[1 : 1 + m], seen[1 + m :].reshape(m, s.factors)
    value = np.ones(m) if value is None else value
    rng = np.random.default_rng(seed)
    for _ in range(s.epochs):
        order = rng.permutation(len(y))
        for batch in np.array_split(order, max(1, len(y) // s.batch)):
            n = np.diff(bounds)[batch]
            at = places[np.repeat(bounds[batch] - np.cumsum(n) + n, n) + np.arange(n.sum())]
            b = np.concatenate([[0], np.cumsum(n)])
            # Only the terms of the batch move.
            used, at = np.unique(at, return_inverse=True)
            x = value[used]
            scaled = v[used] * x[:, None]
            out, total = margin(at, b, p[0], w[used] * x, scaled)
            g = (_sigmoid(out) - y[batch]) * weight[batch] / len(batch)
            row = np.repeat(np.arange(len(batch)), n)
            pull = g[row][:, None] * (total[row] - scaled[at])
            step_w = np.bincount(at, weights=g[row], minlength=len(used)) * x + s.l2 * w[used]
            step_v = np.column_stack([np.bincount(at, weights=pull[:, k], minlength=len(used)) for k in range(s.factors)]) * x[:, None] + s.l2 * v[used]
            seen[0] += g.sum() ** 2
            seen_w[used] += step_w**2
            seen_v[used] += step_v**2
            p[0] -= s.rate * g.sum() / np.sqrt(seen[0])
            w[used] -= s.rate * step_w / np.sqrt(seen_w[used])
            v[used] -= s.rate * step_v / np.sqrt(seen_v[used])
    return p


def fit(docs: DataFrame, labels: DataFrame, column: str = "toxic", settings: Settings = Settings()) -> Model:
    s = settings
    known = training_labels(labels, column).withColumn("positive", F.col("y") >= 0.5)
    totals = {r.positive: r["count"] for r in known.groupBy("positive").count().collect()}
    if len(totals) < 2:
        p = min(max(1.0 if True in totals else 0.0, 1e-6), 1 - 1e-6)
        return Model(np.zeros(1, np.uint32), float(np.log(p / (1 - p))), np.zeros(1), np.zeros((1, s.factors)))
    ranked = lambda positive: known.where(F.col("positive") == positive).orderBy(F.xxhash64("label_id", F.lit(s.seed)), "label_id").limit(s.sample)
    chosen = ranked(True).union(ranked(False)).select("label_id", F.col("positive").cast("double").alias("y"))
    # At most 2 * sample rows of two numbers: a bounded broadcast, so that no text is shuffled.
    texts = docs.select(F.col("doc_id").cast("long").alias("row"), "text")
    picked = texts.join(F.broadcast(chosen), F.col("row") == F.col("label_id")).select("y", "row", "text")
    made = terms_of_rows(picked, s.bits)
    packed = made.columns[2]
    # An id that repeats counts once for each different term set, up to a bound: its copies neither fill a shard nor outweigh others.
    place = F.row_number().over(W.partitionBy("row").orderBy(F.xxhash64(packed), packed))
    rows = made.dropDuplicates(["row", packed]).withColumn("place", place).where(F.col("place") <= s.texts).select(*made.columns)
    rows = materialize(rows, "toxic-terms")
    if len(rows.select("y").distinct().collect()) < 2:
        first = rows.agg(F.avg("y")).first()[0] or 0.0
        p = min(max(first, 1e-6), 1 - 1e-6)
        return Model(np.zeros(1, np.uint32), float(np.log(p / (1 - p))), np.zeros(1), np.zeros((1, s.factors)))
    terms, value = _values(rows, s)
    if not len(terms):
        terms, value = np.zeros(1, np.uint32), np.ones(1)
    m = len(terms)
    share = {k: min(n, s.sample) for k, n in totals.items()}
    weights = np.array([totals[False] / share[False], totals[True] / share[True]])
    weights /= weights.min()
    rng = np.random.default_rng(s.seed)
    params = np.concatenate([[0.0], np.zeros(m), rng.normal(scale=0.01, size=m * s.factors)]).astype(np.float32)

    def train(t: pa.Table) -> pa.Table:
        """One shard, about 2 * sample * texts / shards rows of buckets at most; its number is no partition's."""
        y, row, packed = t["y"].to_numpy(), t["row"].to_numpy(), t["terms"].to_pylist()
        order = np.lexsort((y, row))
        places, bounds = _known([packed[k] for k in order], terms)
        y = y[order]
        out = _train(places, bounds, y, weights[(y >= 0.5).astype(int)], params, s, s.seed + turn, value).astype(np.float32)
        some = [out[k : k + CHUNK].tobytes() for k in range(0, len(out), CHUNK)]
        same = lambda x: pa.array(np.full(len(some), x))
        return pa.table({"chunk": pa.array(np.arange(len(some))), "shard": same(t["shard"][0].as_py()), "n": same(len(y)), "params": pa.array(some, pa.binary())})

    def mean(t: pa.Table) -> pa.Table:
        t = t.sort_by("shard")  # a sum in a fixed order
        parts = np.stack([np.frombuffer(x, np.float32) for x in t["params"].to_pylist()])
        out = np.average(parts.astype(np.float64), axis=0, weights=t["n"].to_numpy()).astype(np.float32)
        return pa.table({"chunk": t["chunk"][:1], "params": pa.array([out.tobytes()], pa.binary())})

    # Dealt once for all rounds, not once for each: rows of fixed number, dealt again from the table if an executor is lost.
    shards = rows.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(s.shards))).repartition(s.shards, "shard").persist()
    for turn in range(s.rounds):
        found = shards.groupBy("shard").applyInArrow(train, "chunk long, shard long, n long, params binary").repartition(8, "chunk")
        found = found.groupBy("chunk").applyInArrow(mean, "chunk long, params binary").collect()  # one row for each CHUNK parameters
        params = np.concatenate([np.frombuffer(r.params, np.float32) for r in sorted(found, key=lambda r: r.chunk)])
    shards.unpersist()
    scaled = params[1 + m :].reshape(m, s.factors) * value[:, None]
    return Model(terms, float(params[0]), params[1 : 1 + m] * value, scaled, s.bits)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) for every row; one pass, no shuffle."""
    packed = model.packed()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model.unpacked(packed)
        place = np.full(2 + (1 << model.bits), -1)  # of each bucket in the model
        place[model.terms] = np.arange(len(model.terms))
        place[0] = -1
        for rows, text in text_slices(batches, "text"):
            w = ts.words(text)
            at = place[hashed_terms(w.dictionary, model.bits)]
            hit = at >= 0
            any_hit = hit.any(1)
            use = any_hit[w.idx] if len(w.idx) else np.zeros(0, bool)
            doc, word = w.doc[use], w.idx[use]
            kind = np.uint32 if len(text) * len(model.terms) < 1 << 32 else np.uint64  # half as wide sorts twice as fast
            pairs = _distinct((np.repeat(doc.astype(kind), 3) * kind(len(model.terms)) + at.astype(kind)[word].ravel())[hit[word].ravel()])
            places, row = pairs % kind(len(model.terms)), pairs // kind(len(model.terms))
            out, _ = margin(places, np.searchsorted(row, np.arange(len(text) + 1)), model.w0, model.w, model.v)
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(_sigmoid(out))], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(task, "doc_id long, score double")


def op3_toxicity_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
