"""Token ids of whole texts by a word-level BPE of the tokenizers library, each different word of a slice encoded once.

The vocabulary's pre-tokenizer drops white space, so a text's ids are its words' ids one after another (words: runs of
other characters than ASCII white space). A slice's words are dictionary-encoded, each word of its dictionary is encoded in
numpy for all words at once (``bulk_bpe``) or, where its shape is unusual, by the library unless its ids are still
remembered, and the ids are gathered back by word.
Texts that hold a special token's string, in whatever case, go to the library whole. Tests compare every text with the library.
"""

from __future__ import annotations

import functools
import os
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meteocube.llm import textstats as ts
from meteocube.llm.common import text_slices

END_ID = 2
WORD_BPE = "word_bpe_49k.json"
BYTE_BPE = "byte_bpe_50k.json"


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file (the default of the operators' path parameter)."""
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.lru_cache(maxsize=4)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks share out the cores
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def specials(t) -> dict[int, str]:
    return {k: v.content for k, v in t.get_added_tokens_decoder().items()}


def gather(values: np.ndarray, bounds: np.ndarray, idx: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs ``idx`` of a ragged array, one after another, and the bounds of the runs."""
    n = np.diff(bounds)[idx]
    ends = np.cumsum(n)
    at = np.repeat(bounds[idx] - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)
    return values[at], np.concatenate([[0], ends])


class Pieces:
    """Ids of pieces of text, each by itself, with the latest pieces remembered.

    Two generations of at most ``keep`` pieces each bound the memory; what is forgotten is encoded again.
    """

    def __init__(self, path: str, keep: int = 300_000):
        self.t, self.keep = tokenizer(path), keep
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def encode(self, pieces: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each piece; no piece may hold a special token's string."""
        new, old = self.new, self.old
        out = [new.get(x) for x in pieces]
        missing = []
        for k, ids in enumerate(out):
            if ids is None:
                ids = old.get(pieces[k])
                if ids is None:
                    missing.append(k)
                else:
                    out[k] = new[pieces[k]] = ids
        for at in range(0, len(missing), 65536):
            part = missing[at : at + 65536]
            for k, e in zip(part, self.t.encode_batch_fast([pieces[k] for k in part], add_special_tokens=False), strict=True):
                out[k] = new[pieces[k]] = array("I", e.ids).tobytes()
        if len(new) > self.keep:
            self.old, self.new = new, {}
        return out


@functools.lru_cache(maxsize=2)
def pieces_of(path: str) -> Pieces:
    """One memory for each worker process."""
    return Pieces(path)


def ragged(runs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Flat ids and bounds of runs of little-endian unsigned 32-bit ids."""
    sizes = np.fromiter(map(len, runs), np.int64, len(runs)) // 4
    return np.frombuffer(b"".join(runs), "<u4"), np.concatenate([[0], np.cumsum(sizes)])


def _word_ids(path: str, dictionary: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of each word of a dictionary, flat, and bounds: runs of letters in bulk, words of other shapes by the library."""
    from meteocube.llm.bulk_bpe import word_ids

    names = [s.lower() for s in specials(tokenizer(path)).values()]

    def rest(words: list[str]) -> list[bytes]:
        # Texts that hold a special token's string are encoded whole afterwards: their words need no ids here.
        return pieces_of(path).encode(["" if "<|" in x and any(s in x.lower() for s in names) else x for x in words])

    return word_ids(path, dictionary, lower=True, rest=rest)


def encode_slice(path: str, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of every text of a slice, flat, and the texts' bounds."""
    t, w = tokenizer(path), ts.words(text)
    out, word_bounds = gather(*_word_ids(path, w.dictionary), w.idx)
    return whole_texts(t, text, out, word_bounds[w.offsets], has_special(t, text))


def has_special(t, text: pa.Array) -> np.ndarray:
    """Texts that hold a special token's string, as it is or once lower-cased (``_word_ids`` lower-cases words)."""
    found = [pc.match_substring(x, s).to_numpy(zero_copy_only=False) for x in (text, pc.ascii_lower(text)) for s in specials(t).values()]
    return functools.reduce(np.logical_or, found) if found else np.zeros(len(text), bool)


def whole_texts(t, text: pa.Array, ids: np.ndarray, bounds: np.ndarray, odd: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The given ids, but with those of the ``odd`` texts by the library from the whole text."""
    if not odd.any():
        return ids, bounds
    parts = [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    for k in np.flatnonzero(odd):
        parts[k] = np.array(t.encode(text[int(k)].as_py(), add_special_tokens=False).ids, dtype=np.uint32)
    return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])


def with_end(ids: np.ndarray, bounds: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Every text's ids followed by ``end_id``."""
    return np.insert(ids, bounds[1:], end_id).astype(np.uint32), bounds + np.arange(len(bounds))


def narrow(path: str) -> str:
    """The smallest integer type that holds every id of the vocabulary."""
    return "<u2" if tokenizer(path).get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4"


def encode_documents(docs: DataFrame, path: str, end_id: int = END_ID, kind: str = "<u4") -> DataFrame:
    """(doc_id, ids) for every row: its text's ids and the end id as integers of the given type.

    A null text is an empty text: the end id alone.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, text in text_slices(batches, "text"):
            ids, bounds = with_end(*encode_slice(path, text), end_id)
            yield pa.RecordBatch.from_arrays([rows.column(0), ragged_binary(ids, bounds, kind)], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(task, "doc_id long, ids binary")


def ragged_binary(ids: np.ndarray, bounds: np.ndarray, kind: str = "<u4") -> pa.Array:
    """Runs of ids as one binary value each, without a copy for each run."""
    data = np.ascontiguousarray(ids, kind)
    offsets = (bounds * data.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def ragged_ids(column: pa.Array, kind: str = "<u4") -> tuple[np.ndarray, np.ndarray]:
    """The inverse of ``ragged_binary``: flat ids and bounds (nulls: no ids)."""
    if column.null_count:
        column = pc.fill_null(column, b"")
    if not len(column) or column.buffers()[2] is None:
        return np.zeros(0, kind), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data.view(kind), (offsets - offsets[0]) // np.dtype(kind).itemsize
