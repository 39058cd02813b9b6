"""The bulk encoders give the libraries' ids for every text."""

import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import EDGE, prose
from tokenizers import Tokenizer

from meteocube.llm import bulk_bpe, tokens

WORD, BYTE, PIECE = (tokens.vocabulary(x) for x in (tokens.WORD_BPE, tokens.BYTE_BPE, "piece_bpe_32k.model"))
ODD = ["a\n\nb", "a\n\n", "\n\na", "\n\n\na", "a\nb\n", " a", " ", "a ", "\n", " \n", "\n ", "don't <|endoftext|> x", "zażółć ▁x y▁ ▁", "a  b", "a\tb",
       "(Hello)World [x] --dash-- e.g. 3,5 %% ~~", "ÀÉ Çß ÿ Ø×÷ İı", "x" * 70 + " " + "y" * 58 + " " + "z" * 59 + " " + "é" * 30, "<|EndOfText|>it's", "\x00 \x1c ", "ff ﬀ ℌ", "é é"]
TEXTS = [t or "" for _, t in EDGE] + ODD + [prose(200, s) for s in range(5)]


def library(path, plain=False):
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    t.encode_special_tokens = plain
    return lambda text: t.encode(text, add_special_tokens=False).ids


def whole(text):
    return np.array(library(BYTE, True)(text), np.uint32)


CASES = {
    "word": (lambda x: tokens.encode_slice(WORD, x), library(WORD)),
    "byte": (lambda x: bulk_bpe.byte_texts(BYTE, x), library(BYTE)),
    "byte_plain": (lambda x: bulk_bpe.byte_texts(BYTE, x, " ", whole), lambda text: library(BYTE, True)(" " + text)),
    "piece": (lambda x: bulk_bpe.piece_words(PIECE).texts(x), lambda text: bulk_bpe.piece_words(PIECE).sp.encode(text)),
}


def same(name, texts):
    encode, want = CASES[name]
    ids, bounds = encode(pa.array(texts, pa.large_string()))
    assert len(bounds) == len(texts) + 1
    for k, text in enumerate(texts):
        assert ids[bounds[k] : bounds[k + 1]].tolist() == want(text), repr(text[:100])


@pytest.mark.parametrize("name", CASES)
def test_every_text_equals_the_library(name):
    same(name, TEXTS)
    same(name, [])
    same(name, [""])


@pytest.mark.parametrize("name", ["word", "byte", "piece"])
def test_random_words(name):
    rng = random.Random(7)
    letters = "etaoinshrdlucmfwypvbgkqjxzETAÄéßñ"
    words = ["".join(rng.choices(letters, k=rng.randint(1, 64))) + rng.choice(["", ".", ",%%%", "'s", "3", ")"]) for _ in range(3000)]
    same(name, [" ".join(words[k : k + 50]) for k in range(0, len(words), 50)])


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="ab Ée\n.,'\"<|1 \t▁漢", max_size=30), max_size=6))
def test_any_text(texts):
    for name in ("word", "byte", "piece"):
        same(name, texts)


def test_merges_take_the_leftmost_of_the_best():
    m = bulk_bpe.Merges(np.array([0, 1]), np.array([0, 0]), np.array([0, 1]), np.array([1, 2]))  # 00 -> 1, 10 -> 2
    ids, bounds = m.encode(np.array([0, 0, 0, 0, 0, 0, 0]), np.array([0, 3, 3, 7]))
    assert ids.tolist() == [2, 1, 1] and bounds.tolist() == [0, 1, 1, 3]
