"""Quality classifier: random Fourier features of document statistics, ridge scores, isotonic calibration.

1. Every text is reduced to ``STATISTICS`` (counts and shares of words, characters, repeats and lines).
2. Standardised statistics x become z = sqrt(2 / D) * cos(W x + b) with W drawn from a normal law, so that
   z . z' approximates the Gaussian kernel of x and x'.
3. Each partition of the labelled rows (folds 1-3) sums its part of the normal equations Z'Z, Z'y; the
   partial sums are added in two levels, and one D x D system is solved (its size does not depend on the data).
4. The raw scores of fold 4 are counted in fixed bins; pool-adjacent-violators over the bins gives a monotone
   map to probabilities, interpolated between bins.

Defined results: a null text is an empty text; an empty text has all statistics 0 and gets the score of that
point; equal texts get equal scores; without any label, or with one class only, every score is the mean label
(0.5 without labels); an empty table gives an empty result; repeated rows each give a row; only ``doc_id`` and
``text`` are read, so further columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meteocube.llm import textstats as ts
from meteocube.llm.common import held_out, materialize, table, text_slices, training_labels

STATISTICS = (
    "log_words", "word_chars", "upper", "digits", "symbols", "marks", "other_punctuation", "ends", "distinct",
    "adjacent", "in_repeats", "top_word", "line_words", "dup_lines",
)
THRESHOLD = 0.3
BINS = 512  # calibration bins for each unit of raw score


@dataclass(frozen=True)
class Settings:
    features: int = 256
    #: kernel width in units of sqrt(number of statistics)
    width: float = 0.7
    ridge: float = 1e-3
    seed: int = 20240501


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    w: np.ndarray
    b: np.ndarray
    beta: np.ndarray | None
    knots: np.ndarray
    values: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        return fourier(x, self) @ self.beta

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.beta is None:
            return np.full(len(x), self.values[0])
        return np.clip(np.interp(self.raw(x), self.knots, self.values), 0.0, 1.0)


def document_statistics(text: pa.Array) -> np.ndarray:
    """One row of STATISTICS for each text; all 0 for a text without words."""
    w = ts.words(text)
    n_words = w.counts.astype(np.float64)
    chars_of = ts.word_chars(w)
    chars = np.maximum(w.per_doc(chars_of), 1)
    share = lambda pattern: w.per_doc(ts.count_in_words(w.dictionary, pattern)) / chars if len(w.dictionary) else np.zeros(len(text))
    per_word = np.maximum(n_words, 1)
    different, top = ts.distinct_and_top(w)
    lines, dup = ts.duplicate_lines(text)
    out = np.column_stack([
        np.log1p(n_words),
        np.log1p(w.per_doc(chars_of) / per_word),
        share(r"\p{Lu}"),
        share(r"\p{Nd}"),
        share(ts.SYMBOLS),
        share(r"[!?]"),
        share(r"[^\p{L}\p{N}!?#*$%&|<>]"),
        share(r"[.!?]$"),
        different / np.maximum(per_word**0.85, 1),
        ts.adjacent_repeats(w) / per_word,
        ts.repeated_window_words(w) / per_word,
        top / per_word,
        np.log1p(n_words / np.maximum(lines, 1)),
        dup / np.maximum(lines, 1),
    ])
    out[n_words == 0] = 0.0
    return out


def fourier(x: np.ndarray, m: Model) -> np.ndarray:
    z = np.clip((x - m.mean) / m.scale, -6, 6)
    z = np.sqrt(2 / len(m.b)) * np.cos(z @ m.w + m.b)
    return np.column_stack([z, np.ones(len(x))])


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.float64).reshape(len(column), len(STATISTICS))


def statistics_table(docs: DataFrame) -> DataFrame:
    """(doc_id, x): the statistics of every text as packed doubles; one pass, no shuffle."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, text in text_slices(batches, "text"):
            x = document_statistics(text)
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array([r.tobytes() for r in x], pa.binary())], names=["doc_id", "x"])

    docs = docs.select(F.col("doc_id").cast("long"), "text")
    return docs.mapInArrow(task, "doc_id long, x binary")


def _sums(rows: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray, float]:
    """Normal equations Z'Z, Z'y and the row count, summed by partition and then in two levels."""
    d = len(model.b) + 1

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g, r, n = np.zeros((d, d)), np.zeros(d), 0
        for batch in batches:
            if batch.num_rows:
                z = fourier(_matrix(batch.column(0)), model)
                g += z.T @ z
                r += z.T @ batch.column(1).to_numpy()
                n += batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array([np.concatenate([g.ravel(), r, [n]]).tobytes()], pa.binary())], names=["part"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(d * d + d + 1)
        for batch in batches:
            for part in batch.column(0).to_pylist():
                total += np.frombuffer(part)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["part"])

    parts = rows.select("x", "y").mapInArrow(task, "part binary")
    # At most 16 sums reach the driver, whatever the number of partitions.
    total = sum(np.frombuffer(r.part) for r in parts.repartition(16).mapInArrow(add, "part binary").collect())
    return total[: d * d].reshape(d, d), total[d * d : -1], float(total[-1])


def pool_adjacent(y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted least-squares non-decreasing fit."""
    blocks: list[list[float]] = []
    for v, w in zip(y, weight, strict=True):
        blocks.append([v, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            b, a = blocks.pop(), blocks.pop()
            blocks.append([(a[0] * a[1] + b[0] * b[1]) / (a[1] + b[1]), a[1] + b[1], a[2] + b[2]])
    return np.concatenate([np.full(int(n), v) for v, _, n in blocks]) if blocks else np.zeros(0)


def fit(docs: DataFrame, labels: DataFrame, column: str = "quality", settings: Settings = Settings()) -> Model:
    """Model of ``labels.column`` from the rows that may be learned from."""
    known = training_labels(labels, column)
    seen = statistics_table(docs)
    seen = materialize(seen.join(known, seen.doc_id == known.label_id).select("x", "y", "fold"), "quality-stats")

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = np.zeros((3, len(STATISTICS)))
        for batch in batches:
            x = _matrix(batch.column(0))
            s[0] += len(x)
            s[1] += x.sum(0)
            s[2] += (x * x).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array([i for i in range(len(STATISTICS))]), *[pa.array(v) for v in s]], names=["i", "n", "s", "q"])

    sums = seen.select("x").mapInArrow(moments, "i long, n double, s double, q double").groupBy("i").agg(F.sum("n"), F.sum("s"), F.sum("q")).orderBy("i").collect()
    n = sums[0][1] if sums else 0
    rng = np.random.default_rng(settings.seed)
    k = len(STATISTICS)
    w = rng.normal(size=(k, settings.features)) / (settings.width * np.sqrt(k))
    model = Model(np.zeros(k), np.ones(k), w, rng.uniform(0, 2 * np.pi, settings.features), None, np.zeros(1), np.full(1, 0.5))
    if not n:
        return model
    model.mean = np.array([r[2] for r in sums]) / n
    spread = np.sqrt(np.maximum(np.array([r[3] for r in sums]) / n - model.mean**2, 0))
    model.scale = np.where(spread > 1e-9, spread, 1.0)
    overall = seen.agg(F.avg("y"), F.min("y"), F.max("y")).first()
    model.values = np.full(1, overall[0])
    if overall[1] == overall[2]:
        return model
    g, r, rows = _sums(seen.where("fold <> 4"), model)
    if not rows:
        return model
    ridge = settings.ridge * rows / settings.features * np.eye(len(r))
    ridge[-1, -1] = 1e-9 * rows
    beta = np.linalg.solve(g + ridge, r)

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.floor(np.clip(fourier(_matrix(batch.column(0)), model) @ beta, -0.5, 1.5) * BINS).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at), batch.column(1)], names=["bin", "y"])

    bins = seen.where("fold = 4").select("x", "y").mapInArrow(binned, "bin long, y double")
    bins = bins.groupBy("bin").agg(F.sum("y").alias("s"), F.count("y").alias("n")).orderBy("bin").collect()
    model.beta = beta
    if bins:
        # Half a row of the mean label in each bin keeps empty evidence from becoming certainty.
        weight = np.array([b.n for b in bins], float)
        model.values = pool_adjacent((np.array([b.s for b in bins]) + 0.05 * overall[0]) / (weight + 0.05), weight)
        model.knots = (np.array([b.bin for b in bins]) + 0.5) / BINS
    else:
        model.knots, model.values = np.array([0.0, 1.0]), np.array([0.0, 1.0])
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) for every row."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, text in text_slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(model.score(document_statistics(text)))], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(task, "doc_id long, score double")


def keep(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` (all their columns) that score ``threshold`` or more."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, text in text_slices(batches, "text"):
            yield rows.filter(pa.array(model.score(document_statistics(text)) >= threshold))

    return docs.mapInArrow(task, docs.schema)


def op1_quality_rff(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep(docs, fit(docs, table(spark, sf_dir, "labels")))
