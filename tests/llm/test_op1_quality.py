import numpy as np
import pyarrow as pa
import pytest
from llm_helpers import EDGE, docs_df, prose, rows_of

from meteocube.llm import quality_rff as q
from meteocube.llm import textstats as ts


def junk(k):
    return " ".join([f"buy{k % 7}!!"] * 60) if k % 2 else " ".join(w.upper() + "###" for w in prose(60, k).split())


@pytest.fixture(scope="module")
def known(spark):
    rows = [(k, prose(70 + k % 50, k) if k % 3 else junk(k)) for k in range(300)]
    labels = spark.createDataFrame([(k, 1 if k % 3 else 0, 0) for k in range(300)], "doc_id long, quality int, toxic int")
    return docs_df(spark, rows), labels


def test_held_out_rows_are_told_apart(spark, known):
    docs, labels = known
    model = q.fit(docs, labels)
    got = {r.doc_id: r.score for r in q.score(docs, model).collect()}
    assert len(got) == 300 and all(0 <= s <= 1 for s in got.values())
    assert np.mean([(got[k] >= q.THRESHOLD) == bool(k % 3) for k in got]) >= 0.97
    kept = {r.doc_id for r in q.keep(docs, model).collect()}
    assert kept == {k for k, s in got.items() if s >= q.THRESHOLD}


def test_labels_of_held_out_rows_do_not_matter(spark, known):
    docs, labels = known
    from meteocube.llm.common import held_out
    from pyspark.sql import functions as F

    lies = labels.withColumn("quality", F.when(held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = q.fit(docs, labels), q.fit(docs, lies)
    assert np.allclose(a.beta, b.beta) and np.allclose(a.values, b.values)


def test_partition_sums_equal_one_least_squares_fit(spark, known):
    docs, labels = known
    model = q.fit(docs.repartition(7), labels, settings=q.Settings(features=16))
    pdf = docs.toPandas()
    import zlib

    train = pdf[[zlib.crc32(str(k).encode()) % 5 in (1, 2, 3) for k in pdf.doc_id]]
    x = q.document_statistics(pa.array(train.text.tolist(), pa.large_string()))
    z = q.fourier(x, model)
    y = np.array([1.0 if k % 3 else 0.0 for k in train.doc_id])
    ridge = 1e-3 * len(y) / 16 * np.eye(17)
    ridge[-1, -1] = 1e-9 * len(y)
    assert np.allclose(np.linalg.solve(z.T @ z + ridge, z.T @ y), model.beta, atol=1e-6)


def test_fourier_features_approximate_the_kernel():
    k = len(q.STATISTICS)
    rng = np.random.default_rng(0)
    width = 0.7 * np.sqrt(k)
    m = q.Model(np.zeros(k), np.ones(k), rng.normal(size=(k, 20000)) / width, rng.uniform(0, 2 * np.pi, 20000), None, None, None)
    x = rng.normal(size=(6, k))
    z = q.fourier(x, m)[:, :-1]
    true = np.exp(-((x[:, None] - x[None]) ** 2).sum(-1) / (2 * width**2))
    assert np.abs(z @ z.T - true).max() < 0.05


def test_pool_adjacent_is_the_monotone_least_squares_fit():
    assert q.pool_adjacent(np.array([1.0, 3, 2, 4]), np.ones(4)).tolist() == [1, 2.5, 2.5, 4]
    assert q.pool_adjacent(np.array([5.0, 1]), np.array([1.0, 3])).tolist() == [2, 2]


def test_statistics_match_plain_python():
    texts = [t or "" for _, t in EDGE]
    got = q.document_statistics(pa.array(texts, pa.large_string()))
    for t, row in zip(texts, got, strict=True):
        words = t.encode().split()
        assert np.isclose(row[0], np.log1p(len(words)))
        if words:
            assert np.isclose(row[q.STATISTICS.index("adjacent")], sum(a == b for a, b in zip(words, words[1:])) / len(words))
            assert np.isclose(row[q.STATISTICS.index("top_word")], max(words.count(w) for w in set(words)) / len(words)) if len(words) < 1000 else True
        else:
            assert not row.any()
    w = ts.words(pa.array(texts, pa.large_string()))
    assert w.counts.tolist() == [len(t.encode().split()) for t in texts]


def test_edge_rows_empty_tables_and_clashing_columns(spark, known):
    docs, labels = known
    model = q.fit(docs, labels)
    edge = docs_df(spark, EDGE, score="s", x="x", y="y", fold="f", label_id="l")
    got = rows_of(q.score(edge, model), "doc_id", "score")
    assert len(got) == len(EDGE)
    same = [s for k, s in got if k in (2, 3, 4)]
    assert len(set(same)) == 1
    assert q.keep(edge, model).columns == edge.columns
    assert q.score(edge.limit(0), model).count() == 0
    empty = labels.limit(0)
    assert {r.score for r in q.score(edge, q.fit(edge, empty)).collect()} == {0.5}
    one = spark.createDataFrame([(1, 1, 0), (1, None, 0), (None, 0, 0)], "doc_id long, quality int, toxic int")
    assert {r.score for r in q.score(edge, q.fit(edge, one)).collect()} <= {0.5, 1.0}
    assert q.fit(edge.limit(0), labels).beta is None
