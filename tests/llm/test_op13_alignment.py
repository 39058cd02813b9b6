"""Token alignment against a plain per-document version with the libraries."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from llm_helpers import EDGE, docs_df, prose, rows_of, ship
from tokenizers import Tokenizer

from meteocube.llm import token_alignment as ta
from meteocube.llm.bulk_bpe import alphabet
from meteocube.llm.common import table
from meteocube.llm.tokens import BYTE_BPE, vocabulary

A, B = vocabulary(BYTE_BPE), vocabulary(ta.PIECE_BPE)
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def tokens_of(text, t, sp, back):
    """(id, start, end) on both sides, or none."""
    if not text:
        return [], []
    raw = (" " + text).encode()
    out = []
    for ids, data in (
        (t.encode(" " + text, add_special_tokens=False).ids, lambda k: bytes(back[c] for c in t.id_to_token(k))),
        (sp.encode(text), lambda k: bytes([int(sp.id_to_piece(k)[3:5], 16)]) if sp.is_byte(k) else sp.id_to_piece(k).replace("▁", " ").encode()),
    ):
        parts = [data(k) for k in ids]
        if b"".join(parts) != raw:
            return [], []
        ends = np.cumsum([len(p) for p in parts]).tolist()
        out.append([(k, e - len(p), e) for k, p, e in zip(ids, parts, ends, strict=True)])
    return out


def brute(docs):
    t = Tokenizer.from_file(A)
    t.no_truncation()
    t.no_padding()
    t.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=B)
    back = {c: b for b, c in enumerate(alphabet())}
    rows, held = [], Counter()
    for doc_id, text in docs:
        a, b = tokens_of(text, t, sp, back)
        ends = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, i, j = [], 0, 0
        for e in ends:
            left, right = [], []
            while i < len(a) and a[i][2] <= e:
                left.append(a[i][0])
                i += 1
            while j < len(b) and b[j][2] <= e:
                right.append(b[j][0])
                j += 1
            groups.append((left, right))
        links, j = [], 0
        for k, s, e in a:
            while b[j][2] <= s:
                j += 1
            m = j
            while m < len(b) and b[m][1] < e:
                links.append((k, b[m][0]))
                m += 1
        held.update(set(links))
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        rows.append((doc_id, len(a), len(b), len(groups), links, hashlib.sha256(text.encode()).hexdigest() if a else ""))
    top = defaultdict(int)
    for (x, _), n in held.items():
        top[x] = max(top[x], n)
    return [(d, na, nb, ng, len(ls), sum(held[p] == top[p[0]] for p in ls), sum(held[p] for p in ls), sha) for d, na, nb, ng, ls, sha in rows], held


def test_documents_and_pairs_match_brute_force(spark):
    extra = [(100, "▁ a ▁"), (101, "a  b"), (102, " a"), (103, "<|endoftext|> </s> <s>"), (104, "\n\n"), (105, "1234567 88 é€漢 \t x"), (106, "\x00")]
    docs = [*EDGE, *extra, *[(k, prose(30, k % 7)) for k in range(200, 240)]]
    want, held = brute(docs)
    got, pairs = ta.align_documents(docs_df(spark, docs, lang="en", pair="x", chunk="y").repartition(3), A, B)
    assert rows_of(got, *COLUMNS) == sorted(want, key=lambda r: [(x is not None, str(x)) for x in r])
    assert {(r.a, r.b): r["count"] for r in pairs.collect()} == held


def test_empty_table(spark):
    got, pairs = ta.align_documents(docs_df(spark, []), A, B)
    assert got.collect() == [] and pairs.collect() == []


def test_several_chunks_give_the_same(spark):
    docs = [(k, prose(40, k % 11)) for k in range(60)]
    want, _ = brute(docs)
    got, _ = ta.align_documents(docs_df(spark, docs).repartition(2), A, B, chunk_docs=7)
    assert rows_of(got, *COLUMNS) == sorted(want, key=lambda r: [(x is not None, str(x)) for x in r])


@pytest.mark.parametrize("n_docs", [1, 7, 8, 300, 60000])
def test_postings_round_trip(n_docs):
    rng = np.random.default_rng(n_docs)
    pair = rng.integers(0, 50, 4000).astype(np.uint64)
    pair[:1500] = 3  # one pair in most documents
    doc = rng.integers(0, n_docs, 4000).astype(np.uint64)
    rows = pa.table(ta.posting_rows(pair << np.uint64(16) | doc, n_docs))
    row, at, links = ta.posting_links(rows, n_docs)
    got = Counter({(int(rows["pair"][int(r)].as_py()), int(d)): int(n) for r, d, n in zip(row, at, links, strict=True)})
    assert got == Counter(zip(pair.tolist(), doc.tolist(), strict=True))


def test_sample_of_the_given_documents(spark):
    ship(spark)
    docs = [(r.doc_id, r.text) for r in table(spark, "/root/testdata/sf0.001", "documents").collect()]
    want, _ = brute(docs)
    got = ta.op13_token_alignment(spark, "/root/testdata/sf0.001")
    assert rows_of(got, *COLUMNS) == sorted(want, key=lambda r: [(x is not None, str(x)) for x in r])
