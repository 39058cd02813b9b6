"""Vectorised word and line counts over an Arrow slice of texts (exact: words are dictionary-encoded, not hashed)."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SYMBOLS = "[#*$%&|<>]"


@dataclass
class Words:
    """Words (runs of other characters than ASCII white space) of n texts.

    dictionary: the different words; idx: a dictionary place for each word, texts one after
    another; offsets: n + 1 bounds of the texts in idx.
    """

    dictionary: pa.Array
    idx: np.ndarray
    offsets: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offsets) - 1), self.counts)

    def per_doc(self, value_of_word: np.ndarray) -> np.ndarray:
        """Sum over each text of a value that depends on the word alone."""
        n = len(self.offsets) - 1
        return np.bincount(self.doc, weights=value_of_word[self.idx], minlength=n) if len(self.idx) else np.zeros(n)


def _encoded(lists: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    offsets = lists.offsets.to_numpy().astype(np.int64)
    encoded = lists.flatten().dictionary_encode()
    return encoded.dictionary, encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64), offsets - offsets[0]


def _only(keep: np.ndarray, idx: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return idx[keep], np.concatenate([[0], np.cumsum(keep)])[offsets]


def words(text: pa.Array) -> Words:
    dictionary, idx, offsets = _encoded(pc.ascii_split_whitespace(text))
    empty = (pc.binary_length(dictionary).to_numpy(zero_copy_only=False) == 0) if len(dictionary) else np.zeros(0, bool)
    if empty.any():
        idx, offsets = _only(~empty[idx], idx, offsets)
    return Words(dictionary, idx, offsets)


def count_in_words(dictionary: pa.Array, pattern: str) -> np.ndarray:
    return pc.count_substring_regex(dictionary, pattern).to_numpy(zero_copy_only=False).astype(np.float64)


def word_chars(w: Words) -> np.ndarray:
    return pc.utf8_length(w.dictionary).to_numpy(zero_copy_only=False).astype(np.float64) if len(w.dictionary) else np.zeros(0)


def _ranks(values: np.ndarray) -> tuple[np.ndarray, int]:
    different, place = np.unique(values, return_inverse=True)
    return place.astype(np.int64), len(different)


def repeated_window_words(w: Words, size: int = 3) -> np.ndarray:
    """Per text: words inside windows of ``size`` words that occur twice or more in that text, first included."""
    n = len(w.offsets) - 1
    out = np.zeros(n, np.int64)
    total = len(w.idx) - size + 1
    if total <= 0:
        return out
    # Each step replaces a pair by its rank, so that no product leaves 64 bits.
    key, width = w.idx[:total].copy(), max(1, len(w.dictionary))
    for k in range(1, size):
        key, _ = _ranks(key * width + w.idx[k : k + total])
    doc = w.doc
    inside = doc[:total] == doc[size - 1 :]
    at = np.flatnonzero(inside)
    if not len(at):
        return out
    _, place, often = np.unique(key[at] * n + doc[at], return_inverse=True, return_counts=True)
    at = at[often[place] >= 2]
    marked = np.zeros(len(w.idx), bool)
    for k in range(size):
        marked[at + k] = True
    return np.bincount(doc[marked], minlength=n).astype(np.int64)


def distinct_and_top(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Per text: different words, and how often its commonest word occurs."""
    n = len(w.offsets) - 1
    pairs, often = np.unique(w.doc * max(1, len(w.dictionary)) + w.idx, return_counts=True)
    doc = pairs // max(1, len(w.dictionary))
    top = np.zeros(n, np.int64)
    np.maximum.at(top, doc, often)
    return np.bincount(doc, minlength=n), top


def adjacent_repeats(w: Words) -> np.ndarray:
    """Per text: words equal to the word before."""
    n, doc = len(w.offsets) - 1, w.doc
    if len(w.idx) < 2:
        return np.zeros(n, np.int64)
    same = (w.idx[1:] == w.idx[:-1]) & (doc[1:] == doc[:-1])
    return np.bincount(doc[1:][same], minlength=n)


def duplicate_lines(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    r"""Per text: lines (split at \n) that hold a word, and those of them that equal an earlier line."""
    n = len(text)
    dictionary, idx, offsets = _encoded(pc.split_pattern(text, "\n"))
    has_word = pc.match_substring_regex(dictionary, r"[^\x20\x09-\x0D]").to_numpy(zero_copy_only=False)
    idx, offsets = _only(has_word[idx], idx, offsets)
    lines = np.diff(offsets)
    pairs = np.unique(np.repeat(np.arange(n), lines) * max(1, len(dictionary)) + idx)
    return lines, lines - np.bincount(pairs // max(1, len(dictionary)), minlength=n)
