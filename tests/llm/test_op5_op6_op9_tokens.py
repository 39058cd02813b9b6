import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from llm_helpers import EDGE, docs_df, prose

from meteocube.llm import bpe_tree as b
from meteocube.llm import huffman_ids as h
from meteocube.llm import pack_pow2 as p
from meteocube.llm import tokens as tk
from meteocube.llm.common import scratch

WORD, BYTE = tk.vocabulary(tk.WORD_BPE), tk.vocabulary(tk.BYTE_BPE)
LONG_TEXTS = [
    "ab" * 20000,
    "é" * 9000 + "x",
    " " * 9000 + "word" + "\n" * 7000 + " end",
    "1234567890" * 2000 + "!?" * 8000 + "漢字" * 6000 + "👩‍👩‍👧" * 3000,
    prose(4000, 5) + "<|endoftext|>" + "z" * 20000 + "<|endoftext|>" + prose(900, 2) + "  tail  ",
    "".join(random.Random(9).choice("abcdefghijklmnopqrstuvwxyz") for _ in range(60000)),
    "\t".join(prose(3, k) for k in range(3000)),
]


def library(path, text):
    return tk.tokenizer(path).encode(text or "", add_special_tokens=False).ids


def ids_of(value):
    return np.frombuffer(value, "<u4").tolist()


def test_word_ids_equal_the_library(spark):
    rows = [*EDGE, *[(100 + k, t) for k, t in enumerate(LONG_TEXTS)]]
    got = sorted((str(r.doc_id), ids_of(r.ids)) for r in tk.encode_documents(docs_df(spark, rows, ids="i"), WORD).collect())
    assert got == sorted((str(i), [*library(WORD, t), tk.END_ID]) for i, t in rows)


def test_memory_of_pieces_only_saves_time():
    few, texts = tk.Pieces(WORD, keep=3), [prose(40, k).split() for k in range(5)]
    for words in texts + texts[::-1]:
        assert few.encode(words) == [np.array(library(WORD, x), "<u4").tobytes() for x in words]
        assert len(few.new) <= 3 + len(words) and len(few.old) <= 3 + 40


def test_random_texts_equal_the_library():
    rng = random.Random(10)
    alphabet = "abcdeXYZ éßΣσςÀ0129٣.,'’!?<|>-_~\n\t\r\x0b\x1c\x85  ​　́ͅﬁ漢👧"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(3000)]
    texts += ["'s 'S it's", "a's'll", "İI ı ŉ ẞ", "ΑΣ ΑΣ. ΑΣΑ Σ", "<|endoftext|", "x<|endoftext|>y z", " <|endoftext|> "]
    arr = pa.array(texts, pa.large_string())
    for path, encode in ((WORD, lambda a: tk.encode_slice(WORD, a)), (BYTE, lambda a: b.encode_slice(BYTE, a))):
        ids, bounds = encode(arr)
        for k, t in enumerate(texts):
            assert ids[bounds[k] : bounds[k + 1]].tolist() == library(path, t), (path, t)


def test_special_tokens_in_other_cases_keep_their_ids(spark):
    texts = ["see<|ENDOFTEXT|>now", "<|EndOfText|>", "a <|STARTofTEXT|>, b", "x<|endoftext|>y <|EndOfText|> z", "<|ENDOFTEXT|", "plain words"]
    for path, encode in ((WORD, lambda a: tk.encode_slice(WORD, a)), (BYTE, lambda a: b.encode_slice(BYTE, a))):
        ids, bounds = encode(pa.array(texts, pa.large_string()))
        for k, t in enumerate(texts):
            assert ids[bounds[k] : bounds[k + 1]].tolist() == library(path, t), (path, t)
    assert len(library(WORD, texts[0])) == 8
    got = {r.doc_id: ids_of(r.ids) for r in tk.encode_documents(docs_df(spark, list(enumerate(texts))), WORD).collect()}
    assert got == {k: [*library(WORD, t), tk.END_ID] for k, t in enumerate(texts)}


# --- Huffman files ---


def test_lengths_are_optimal_within_the_limit():
    rng = np.random.default_rng(11)
    for n, limit in ((2, 4), (5, 3), (7, 4), (40, 8), (300, 9), (3000, 18)):
        counts = (rng.pareto(0.6, n) * 5 + 1).astype(np.int64)
        lengths = h.code_lengths(counts, limit)
        assert lengths.max() <= max(limit, int(np.ceil(np.log2(n)))) and np.isclose((2.0**-lengths).sum(), 1)
    import itertools

    counts = np.array([1, 1, 2, 9, 30])
    best = min(sum(c * x for c, x in zip(counts, t)) for t in itertools.product(range(1, 4), repeat=5) if sum(2.0**-x for x in t) <= 1)
    assert (counts * h.code_lengths(counts, 3)).sum() == best
    assert h.code_lengths(np.array([5])).tolist() == [1] and len(h.code_lengths(np.zeros(0, np.int64))) == 0


def test_codes_are_canonical_and_blocks_round_trip():
    rng = np.random.default_rng(12)
    ids = np.sort(rng.choice(49000, 700, replace=False))
    counts = (rng.pareto(0.5, 700) * 3 + 1).astype(np.int64)
    code = h.Code(ids, h.code_lengths(counts))
    text = [format(c, f"0{n}b") for c, n in zip(code.codes, code.lengths)]
    assert text == sorted(text) and all(not y.startswith(x) for x, y in zip(text, text[1:]))
    for n in (0, 1, h.STEP - 1, h.STEP, h.STEP + 1, 20000):
        flat = rng.choice(ids, n)
        payload, marks = code.encode(flat)
        assert (code.decode(payload, marks, n) == flat).all()
        bits = "".join(text[np.flatnonzero(code.ids == x)[0]] for x in flat[:500])
        assert "".join(f"{x:08b}" for x in payload).startswith(bits)
        half = len(marks) // 2  # a block's second half alone, from its checkpoint
        assert (code.decode(payload, marks[half:], n - half * h.STEP) == flat[half * h.STEP :]).all()


@pytest.mark.parametrize("block", [64, h.BLOCK_IDS])
def test_files_give_back_every_document_in_order(spark, block):
    rows = [*EDGE, *[(1000 - k, prose(k % 40, k)) for k in range(150)]]
    docs = docs_df(spark, rows, ids="i", part="p", start="s")
    path = scratch(spark, "huffman-test")
    kind = "<u4" if block == 64 else tk.narrow(WORD)
    h.write(tk.encode_documents(docs, WORD, kind=kind), path, block, kind)
    got = h.read(spark, path).collect()
    want = [(i, [*library(WORD, t), tk.END_ID]) for i, t in rows]
    assert sorted((str(r.doc_id), ids_of(r.ids)) for r in got) == sorted((str(i), x) for i, x in want)
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += len(r.ids) // 4
    order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order[0] is None and order[1:] == sorted(order[1:])
    blocks = spark.read.parquet(f"{path}/blocks").orderBy("part", "block").collect()
    firsts = [np.frombuffer(x.doc_ids, "<i8")[0] for x in blocks]
    assert firsts == sorted(firsts) and (block > 64 or len(blocks) > 20)


def test_empty_table_of_ids(spark):
    path = scratch(spark, "huffman-empty")
    h.write(tk.encode_documents(docs_df(spark, EDGE).limit(0), WORD), path)
    assert h.read(spark, path).count() == 0


# --- packing ---


def test_piece_lengths_are_binary():
    doc, length = p.piece_lengths(np.array([1, 4096, 8192 + 5, 4095, 6]))
    assert [length[doc == k].tolist() for k in range(5)] == [[1], [4096], [4096, 4096, 4, 1], [2048 >> k for k in range(12)], [4, 2]]
    assert all(length[doc == 1 - 1] > 0)


@pytest.mark.parametrize("longest", [4096, 64])
def test_pieces_hold_every_id_once(spark, longest):
    rows = [*EDGE, *[(100 + k, t) for k, t in enumerate(LONG_TEXTS)]]
    got = p.pack(docs_df(spark, rows, length="l", start="s", first="f", part="p"), WORD, longest=longest).collect()
    assert sorted(r.sequence_id for r in got) == list(range(len(got)))
    by_id = {}
    for r in got:
        assert r.offset == 0 and r.length == len(r.ids) // 4 <= longest and r.length & (r.length - 1) == 0
        by_id.setdefault(r.doc_id, []).append(r)
    for i, t in rows:
        want = [*library(WORD, t), tk.END_ID]
        pieces = sorted(by_id[i], key=lambda r: r.start)
        if i == 7:  # a row that occurs twice
            pieces = pieces[::2]
        assert [x for r in pieces for x in ids_of(r.ids)] == want and {r.doc_tokens for r in pieces} == {len(want)}
        assert [r.start for r in pieces] == np.concatenate([[0], np.cumsum([r.length for r in pieces])[:-1]]).tolist()
    # Buckets are ranges of sequence ids, longest first.
    lengths = [r.length for r in sorted(got, key=lambda r: r.sequence_id)]
    assert lengths == sorted(lengths, reverse=True)
    one = p.digest(p.pack(docs_df(spark, rows[:3]), WORD)).where("doc_id = 3").first()
    assert (one.length, one.ids_crc32) == (1, zlib.crc32(np.array([tk.END_ID], "<u4").tobytes()))


def test_packing_of_an_empty_table_and_bad_length(spark, tmp_path):
    docs = docs_df(spark, EDGE)
    assert p.pack(docs.limit(0), WORD).count() == 0
    p.write_buckets(p.pack(docs, WORD), f"{tmp_path}/b")
    assert (spark.read.parquet(f"{tmp_path}/b/length=1").count()) > 0
    with pytest.raises(ValueError):
        p.pieces(docs, WORD, longest=100)


# --- tree concatenation ---


def test_leaves_joined_equal_the_library():
    for text in LONG_TEXTS:
        for leaf in (64, 500, 4096):
            parts, more = zip(*b.leaves(BYTE, text, leaf), strict=True)
            assert "".join(parts) == text
            ids = [np.array(library(BYTE, x), np.uint32) for x in parts]
            assert b.concatenate(BYTE, ids, list(more)).tolist() == library(BYTE, text)
        if "ab" * 9 in text or "éé" in text:
            assert any(more)


def test_joins_of_random_runs_equal_the_library():
    rng = random.Random(13)
    for alphabet in ("ab", "abc", "aeinrst", "0123", "!?-=", "éèà", "漢字か", "the"):
        for _ in range(40):
            run = "".join(rng.choice(alphabet) for _ in range(rng.randrange(2, 400)))
            cut = rng.randrange(1, len(run))
            left, right = (np.array(library(BYTE, x), np.uint32) for x in (run[:cut], run[cut:]))
            assert b.join(BYTE, left, right, 2).tolist() == library(BYTE, run)


def test_encode_and_decode_equal_the_library(spark):
    rows = [*EDGE, *[(100 + k, t) for k, t in enumerate(LONG_TEXTS)], (107, LONG_TEXTS[0])]
    docs = docs_df(spark, rows, ids="i", uid="u", leaf="l", more="m")
    want = sorted((str(i), library(BYTE, t), t or "") for i, t in rows)
    apart = b.decode(b.encode(docs, BYTE, long=2000, leaf=300), BYTE)
    at_once = b.encode(docs, BYTE, long=2000, leaf=300, texts=True)
    for got in (apart, at_once):
        assert sorted((str(r.doc_id), ids_of(r.ids), r.text) for r in got.collect()) == want
    assert b.encode(docs.limit(0), BYTE).count() == b.encode(docs.limit(0), BYTE, texts=True).count() == 0


def test_decoding_of_any_ids_equals_the_library(spark):
    rng = random.Random(14)
    lists = [[rng.randrange(50257) for _ in range(rng.randrange(12))] for _ in range(400)]
    df = spark.createDataFrame([(k, bytearray(np.array(x, "<u4").tobytes())) for k, x in enumerate(lists)], "doc_id long, ids binary")
    docs_df(spark, EDGE)
    t = tk.tokenizer(BYTE)
    assert {r.doc_id: r.text for r in b.decode(df, BYTE).collect()} == {k: t.decode(x, skip_special_tokens=False) for k, x in enumerate(lists)}
