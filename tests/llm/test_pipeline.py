import zlib

import numpy as np
import pytest
from llm_helpers import docs_df, prose
from test_op2_op8_near_dups import classes_of
from test_op4_rules import brute
from test_op5_op6_op9_tokens import library

import corpus_pipeline
from meteocube.llm import quality_rff, rules_ledger
from meteocube.llm.tokens import END_ID, WORD_BPE, vocabulary


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rows = []
    for k in range(240):
        if k % 6 == 0:
            text = " ".join([f"win{k}!!"] * 80)
        elif k % 6 == 1:
            text = prose(20, k)
        elif k % 6 == 2:
            text = prose(150, k // 30)
        else:
            text = prose(90 + k, 17 * k)
        rows.append((k, text))
    rows += [(300, None), (301, ""), (2, prose(150, 0)), (None, prose(200, 999))]
    d = str(tmp_path_factory.mktemp("corpus"))
    docs_df(spark, rows, lang="en", score="s", failed="f", n_words="n").write.parquet(f"{d}/documents.parquet")
    labels = [(k, 0 if k % 6 == 0 else 1, 0) for k in range(240)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return d


def test_stages_in_order_against_brute_force(spark, corpus):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "quality_rules", "simhash_near_dedup", "packing"]
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    first, second, third, fourth = (f for _, f in corpus_pipeline.STAGES)
    model = quality_rff.fit(docs, spark.read.parquet(f"{corpus}/labels.parquet"))
    a = first(spark, docs, corpus)
    good = {(r.doc_id, r.score) for r in quality_rff.score(docs, model).collect()}
    key = lambda df: sorted((str(r.doc_id), r.text) for r in df.collect())
    assert a.columns == docs.columns
    assert sorted({str(i) for i, _ in key(a)}) == sorted({str(i) for i, s in good if s >= 0.3})
    assert not any("!!" in (r.text or "") for r in a.collect())

    b = second(spark, a, corpus)
    keeps = lambda t: not any(eval(rule, {}, dict(zip(rules_ledger.MEASURES, brute(t)))) for _, rule in rules_ledger.RULES)
    assert key(b) == sorted((str(r.doc_id), r.text) for r in a.collect() if keeps(r.text)) and b.columns == docs.columns

    rows = [(r.doc_id, r.text) for r in b.collect()]
    c = third(spark, b, corpus)
    _, root = classes_of(rows)
    low = {}
    for (i, _), r in zip(rows, root):
        low[r] = min((x for x in (low.get(r), i) if x is not None), default=None)
    assert sorted(i for i, _ in key(c)) == sorted(str(v) for v in low.values()) and c.columns == docs.columns
    assert len(low) < len(rows)

    got = fourth(spark, c, corpus).collect()
    path = vocabulary(WORD_BPE)
    for r in c.collect():
        ids = np.array([*library(path, r.text), END_ID], "<u4")
        pieces = sorted((x for x in got if x.doc_id == r.doc_id), key=lambda x: x.start)
        assert sum(x.length for x in pieces) == len(ids)
        assert all(x.ids_crc32 == zlib.crc32(ids[x.start : x.start + x.length].tobytes()) for x in pieces)


def test_run_gives_the_last_stage_and_takes_empty_tables(spark, corpus, tmp_path):
    out = corpus_pipeline.run(spark, corpus)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] and out.count() > 100
    for name in ("documents", "labels"):
        spark.read.parquet(f"{corpus}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
