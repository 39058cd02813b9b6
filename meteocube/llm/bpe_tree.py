"""Byte-level BPE encoding by tree concatenation, and decoding.

Texts up to ``long`` characters are encoded where they lie: cut before each single space (a place where this
pre-tokenizer always cuts), every different unit of a slice encoded once by the library.

Longer texts are cut into leaves that are rows of their own and are encoded in parallel on other tasks. Leaves end before
white space that follows a visible character; inside a run without such a place they end between pre-tokens; and a single
pre-token longer than a leaf is cut into halves down to leaves. Its leaves' ids are then concatenated pair by pair, up a
tree: the ids around each join are decoded and encoded anew in a window that grows until its first ids agree with the
left side and its last ids with the right side. BPE ids are the right encoding exactly when every two neighbours are, so
such a join equals the encoding of the whole.

Defined results: a null text is an empty text: no ids, decoded to an empty text; repeated rows each give a row; a null doc_id
keeps its row; an empty table gives an empty result; only ``doc_id`` and ``text`` are read. A special token's string
in a text becomes its id, as in the library.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meteocube.llm.common import table, text_slices
from meteocube.llm.tokens import BYTE_BPE, gather, has_special, pieces_of, ragged, ragged_binary, ragged_ids, specials, tokenizer, vocabulary, whole_texts

LONG = 16384
LEAF = 4096
#: Before white space that follows a letter, a digit or ASCII punctuation, no pre-token goes on.
_CUT = re.compile(r"(?<=[\w!-/:-@\[-`{-~])(?=[ \n])")


def _byte_of_char() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 stands for itself, the other bytes for U+0100 onwards."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


@functools.lru_cache(maxsize=2)
def token_bytes(path: str) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of every id, flat, and their bounds."""
    t = tokenizer(path)
    back = _byte_of_char()
    size = max(t.get_vocab(with_added_tokens=True).values()) + 1
    parts = []
    for k in range(size):
        token = t.id_to_token(k) or ""
        parts.append(bytes(back[c] for c in token) if all(c in back for c in token) else token.encode())
    return np.frombuffer(b"".join(parts), np.uint8), np.concatenate([[0], np.cumsum([len(p) for p in parts])])


# --- texts that stay where they are ---


def encode_slice(path: str, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of every text of a slice, flat, and the texts' bounds."""
    t = tokenizer(path)
    odd = pc.match_substring_regex(text, r"[\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200B}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}] ").to_numpy(zero_copy_only=False)
    odd = odd | has_special(t, text)
    plain = pc.if_else(pa.array(odd), "", text)
    lists = pc.split_pattern(plain, " ")
    offsets = lists.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    units = lists.flatten()
    first = np.zeros(len(units), bool)
    first[offsets[:-1]] = True
    later, head = units.filter(pa.array(~first)).dictionary_encode(), units.filter(pa.array(first)).dictionary_encode()
    pieces = [" " + x for x in later.dictionary.to_pylist()] + head.dictionary.to_pylist()
    idx = np.zeros(len(units), np.int64)
    idx[~first] = later.indices.to_numpy(zero_copy_only=False)
    idx[first] = head.indices.to_numpy(zero_copy_only=False) + len(later.dictionary)
    out, bounds = gather(*ragged(pieces_of(path).encode(pieces)), idx)
    return whole_texts(t, text, out, bounds[offsets], odd)


# --- long texts ---


def halves(text: str, leaf: int) -> list[str]:
    """The leaves of a text halved until none is longer than ``leaf``."""
    if len(text) <= leaf:
        return [text]
    mid = len(text) // 2
    return halves(text[:mid], leaf) + halves(text[mid:], leaf)


def leaves(path: str, text: str, leaf: int = LEAF) -> Iterator[tuple[str, bool]]:
    """(part of the text, whether it goes on inside the pre-token of the part before), in order."""
    t = tokenizer(path)
    split = re.compile("(" + "|".join(re.escape(s) for s in specials(t).values()) + ")") if specials(t) else None
    for segment in split.split(text) if split else [text]:
        if split and split.fullmatch(segment):
            yield segment, False
            continue
        cuts = [m.start() for m in _CUT.finditer(segment)] + [len(segment)]
        at, last = 0, 0
        for cut in cuts:
            if cut - at > leaf and last > at:  # as many whole runs as fit
                yield from _run(t, segment[at:last], leaf)
                at = last
            last = cut
        if at < len(segment):
            yield from _run(t, segment[at:], leaf)


def _run(t, run: str, leaf: int) -> Iterator[tuple[str, bool]]:
    if len(run) <= 2 * leaf:
        yield run, False
        return
    at = last = 0
    for _, (a, b) in t.pre_tokenizer.pre_tokenize_str(run):
        if b - a > leaf:
            if a > at:
                yield run[at:a], False
            for k, part in enumerate(halves(run[a:b], leaf)):
                yield part, k > 0
            at = b
        elif b - at > leaf:
            if a > at:
                yield run[at:a], False
            at = a
        last = b
    if last > at:
        yield run[at:last], False


def join(path: str, left: np.ndarray, right: np.ndarray, window: int = 8) -> np.ndarray:
    """Ids of two neighbouring parts of one pre-token as if encoded together."""
    t = tokenizer(path)
    data, bounds = token_bytes(path)
    goes_on = lambda token: (data[bounds[token]] & 0xC0) == 0x80  # noqa: E731  its first byte is inside a character
    while True:
        i, j = max(0, len(left) - window), min(len(right), window)
        while i > 0 and goes_on(left[i]):
            i -= 1
        while j < len(right) and goes_on(right[j]):
            j += 1
        raw, _ = gather(data, bounds, np.concatenate([left[i:], right[:j]]).astype(np.int64))
        anew = np.array(t.encode(raw.tobytes().decode(), add_special_tokens=False).ids, dtype=np.uint32)
        same_left = i == 0 or (len(left) - i >= 2 and np.array_equal(anew[:2], left[i : i + 2]))
        same_right = j == len(right) or (j >= 2 and np.array_equal(anew[-2:], right[j - 2 : j]))
        if same_left and same_right:
            return np.concatenate([left[:i], anew, right[j:]])
        window *= 2


def join_tree(path: str, parts: list[np.ndarray]) -> np.ndarray:
    while len(parts) > 1:
        parts = [join(path, parts[k], parts[k + 1]) if k + 1 < len(parts) else parts[k] for k in range(0, len(parts), 2)]
    return parts[0]


def concatenate(path: str, parts: list[np.ndarray], goes_on: list[bool]) -> np.ndarray:
    """Ids of a text from those of its leaves in order."""
    out: list[np.ndarray] = []
    group: list[np.ndarray] = []
    for ids, more in zip(parts, goes_on, strict=True):
        if group and not more:
            out.append(join_tree(path, group))
            group = []
        group.append(ids)
    if group:
        out.append(join_tree(path, group))
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


def decoded(path: str, ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The text of every run of ids: its bytes as UTF-8, what is not UTF-8 as U+FFFD."""
    data, places = token_bytes(path)
    raw, ends = gather(data, places, ids.astype(np.int64))
    whole = raw.tobytes()
    return pa.array([whole[a:b].decode("utf-8", "replace") for a, b in zip(ends[bounds[:-1]], ends[bounds[1:]], strict=True)], pa.string())


def _encode_long(docs: DataFrame, path: str, leaf: int, texts: bool) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, text in text_slices(batches, "text"):
            for k in range(len(text)):
                parts, more = zip(*leaves(path, text[k].as_py(), leaf), strict=True)
                n = len(parts)
                same = pa.array(np.full(n, k))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0).take(same), rows.column(1).take(same), pa.array(np.arange(n)), pa.array(more), pa.array(parts, pa.string())],
                    names=["uid", "doc_id", "leaf", "more", "text"],
                )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(path)
        for rows, text in text_slices(batches, "text"):
            parts = text.to_pylist()
            ids = []
            for at in range(0, len(parts), 16):  # the library's own result takes far more memory than the ids
                ids += [np.array(e.ids, dtype="<u4").tobytes() for e in t.encode_batch_fast(parts[at : at + 16], add_special_tokens=False)]
            yield pa.RecordBatch.from_arrays([*rows.columns[:4], pa.array(ids, pa.binary())], names=["uid", "doc_id", "leaf", "more", "ids"])

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("leaf")
        ids = concatenate(path, [np.frombuffer(b, "<u4") for b in group.ids], group.more.tolist())
        out = pd.DataFrame({"doc_id": group.doc_id.iloc[:1].to_numpy(), "ids": [ids.astype("<u4").tobytes()]})
        return out.assign(text=decoded(path, ids, np.array([0, len(ids)])).to_pylist()) if texts else out

    cuts = docs.mapInArrow(cut, "uid long, doc_id long, leaf long, more boolean, text string")
    done = cuts.repartition("uid", "leaf").mapInArrow(encode, "uid long, doc_id long, leaf long, more boolean, ids binary")
    # A group is one text's ids: no larger than a row of the input.
    return done.groupBy("uid").applyInPandas(merge, _columns(texts))


def _columns(texts: bool) -> str:
    return "doc_id long, ids binary, text string" if texts else "doc_id long, ids binary"


def encode(docs: DataFrame, path: str, long: int = LONG, leaf: int = LEAF, texts: bool = False) -> DataFrame:
    """(doc_id, ids) for every row; ids as little-endian unsigned 32-bit integers.

    With ``texts`` also ``text``, decoded from the ids by the task that made them: the answer of ``decode`` without
    a second worker beside the first.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    is_long = F.length("text") > long

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, text in text_slices(batches, "text"):
            ids, bounds = encode_slice(path, text)
            columns = [part.column(0), ragged_binary(ids, bounds)]
            if texts:
                columns.append(decoded(path, ids, bounds))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "text"][: len(columns)])

    short = rows.where(~is_long).mapInArrow(task, _columns(texts))
    return short.union(_encode_long(rows.where(is_long).select(F.monotonically_increasing_id().alias("uid"), "doc_id", "text"), path, leaf, texts))


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, text) of (doc_id, ids): the ids' bytes as UTF-8, what is not UTF-8 as U+FFFD."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), decoded(path, *ragged_ids(part.column(1)))], names=["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(task, _columns(True))


def op9_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = vocabulary(BYTE_BPE)
    out = encode(table(spark, sf_dir, "documents"), path, texts=True)
    return out.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))
