"""Byte-pair encoding of many short words at once, in numpy, for the public vocabularies.

The library spends most of its time on making one result object for each word. Here a block of words is a matrix of symbols, one
column for each word, and every step merges the best pair of each word: the pair of lowest order, the leftmost
among equals, which is what the libraries do. Words that this does not cover (long ones, marks beside letters, other scripts) go to
the library. Tests compare every text with the libraries.
"""

from __future__ import annotations

import functools
import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from meteocube.llm.tokens import gather, has_special, pieces_of, ragged, tokenizer, whole_texts

#: Symbols of the longest word that is encoded here (positions must fit into 6 bits beside the borders).
MOST = 60
BLOCK = 32768
_PAD, _NONE = 65535, np.int32(2**31 - 1)
_MARKS = r"[!-&(-/:-@\[-`{-~]*"  # ASCII punctuation but the apostrophe, which starts contractions
_WORD = f"^(?P<head>{_MARKS})(?P<base>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<tail>{_MARKS})$"
#: White space that the byte-level pre-tokenizer does not simply cut before: runs, and kinds other than space and line feed.
_ODD_SPACE = r"[\t\x0B\x0C\r\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200B}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]|[ \n] | \n|\n\n\n|\n\n$"


class Merges:
    """Pairs (left, right) of symbols that merge, the lowest ``order`` first, into ``result[order]``."""

    def __init__(self, left: np.ndarray, right: np.ndarray, order: np.ndarray, result: np.ndarray):
        self.result = np.asarray(result, np.int32)
        keys = np.asarray(left).astype(np.uint32) << np.uint32(16) | np.asarray(right).astype(np.uint32)
        orders = np.asarray(order, np.int32)
        self.tables = []
        bits, factor = 20, 2654435769
        while len(keys):  # what falls on a taken place goes to the next, smaller table
            slot = keys * np.uint32(factor) >> np.uint32(32 - bits)
            table, value = np.full(1 << bits, 2**32 - 1, np.uint32), np.full(1 << bits, _NONE, np.int32)
            table[slot], value[slot] = keys, orders
            out = table[slot] != keys
            self.tables.append((np.uint32(factor), np.uint32(32 - bits), table, value))
            keys, orders = keys[out], orders[out]
            bits, factor = max(10, bits - 3), (factor * 747796405 + 12) % 2**32 | 1

    def order(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.uint32) << np.uint32(16) | right.astype(np.uint32)
        found = np.full(key.shape, _NONE, np.int32)
        for factor, shift, table, value in self.tables:
            slot = key * factor >> shift
            hit = table[slot] == key
            found[hit] = value[slot[hit]]
        return found

    def encode(self, symbols: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of every word (a run of at most ``MOST`` symbols), flat, and bounds."""
        size = np.diff(bounds)
        by_size = np.argsort(size, kind="stable")
        parts, counts = [], np.zeros(len(size), np.int64)
        for at in range(0, len(size), BLOCK):
            words = by_size[at : at + BLOCK]
            n, rows = size[words], int(size[words[-1]])
            block = np.full((rows + 2, len(words)), _PAD, np.int32)
            flat, ends = gather(symbols, bounds, words)
            block[np.arange(len(flat)) - np.repeat(ends[:-1], n) + 1, np.repeat(np.arange(len(words)), n)] = flat
            done = self._merge(block).T
            kept = (done >= 0) & (done != _PAD)
            parts.append(done[kept])
            counts[words] = kept.sum(1)
        if not parts:
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        ends = np.concatenate([[0], np.cumsum(counts[by_size])])
        back = np.empty(len(size), np.int64)
        back[by_size] = np.arange(len(size))
        return gather(np.concatenate(parts).astype(np.uint32), ends, back)

    def _rank(self, left: np.ndarray, right: np.ndarray, row) -> np.ndarray:
        found = self.order(left, right)
        return np.where(found == _NONE, _NONE, found * 64 + row)

    def _merge(self, s: np.ndarray) -> np.ndarray:
        """Merges every column; merged-away places become -1."""
        out, rows, mine = s, len(s), None
        rank = np.full(s.shape, _NONE, np.int32)
        rank[:-1] = self._rank(s[:-1], s[1:], np.arange(rows - 1, dtype=np.int32)[:, None])
        after = np.repeat(np.arange(1, rows + 1, dtype=np.int16)[:, None], s.shape[1], 1)
        before = after - 2
        while True:
            best = rank.min(0)
            live = np.flatnonzero(best != _NONE)
            if not len(live):
                break
            if len(live) * 2 < s.shape[1]:  # go on with the unfinished columns alone
                if mine is not None:
                    out[:, mine] = s
                mine = live if mine is None else mine[live]
                s, rank, after, before, best = s[:, live], rank[:, live], after[:, live], before[:, live], best[live]
                live = np.arange(len(live))
            best = best[live]
            j = best & 63
            k = after[j, live]
            m = after[k, live]
            s[j, live], s[k, live] = self.result[best >> 6], -1
            rank[k, live] = _NONE
            after[j, live], before[m, live] = m, j
            i = before[j, live]
            rank[j, live] = self._rank(s[j, live], s[m, live], j)
            rank[i, live] = self._rank(s[i, live], s[j, live], i.astype(np.int32))
        if mine is not None:
            out[:, mine] = s
        return out


def alphabet() -> list[str]:
    """The byte-level character of every byte: printable Latin-1 stands for itself, the others for U+0100 onwards."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    other = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(other)) for b in range(256)]


class ByteWords:
    """Runs of letters by a byte-level vocabulary file of the tokenizers library, whose last byte may carry a word end."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab = model["vocab"]
        pairs = [x if isinstance(x, list) else x.split(" ") for x in model["merges"]]
        ids = lambda words: np.fromiter((vocab[x] for x in words), np.int64, len(pairs))
        self.merges = Merges(ids(a for a, _ in pairs), ids(b for _, b in pairs), np.arange(len(pairs)), ids(a + b for a, b in pairs))
        end = model.get("end_of_word_suffix") or ""
        self.inner = np.array([vocab[c] for c in alphabet()], np.int32)
        self.last = np.array([vocab[c + end] for c in alphabet()], np.int32)

    def encode(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        raw, bounds = _bytes(words)
        symbols = self.inner[raw]
        ends = bounds[1:][np.diff(bounds) > 0] - 1
        symbols[ends] = self.last[raw[ends]]
        return self.merges.encode(symbols, bounds)


def _bytes(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    words = words.cast(pa.large_binary())
    bounds = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    if not len(words) or words.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(words) + 1, np.int64)
    return np.frombuffer(words.buffers()[2], np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


@functools.lru_cache(maxsize=2)
def byte_words(path: str) -> ByteWords:
    return ByteWords(path)


def pool(*runs: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Ragged arrays one after another: values, bounds, and the number of runs before each."""
    starts = np.cumsum([0, *(len(b) - 1 for _, b in runs)]).tolist()
    offsets = np.cumsum([0, *(len(v) for v, _ in runs)])
    bounds = np.concatenate([[0], *(b[1:] + o for (_, b), o in zip(runs, offsets, strict=False))])
    return np.concatenate([v for v, _ in runs]).astype(np.uint32), bounds.astype(np.int64), starts


def word_ids(path: str, words: pa.Array, lead: str = "", lower: bool = False, rest=None) -> tuple[np.ndarray, np.ndarray]:
    """Ids of each of the given different words: marks, letters and marks are three pre-tokens, the first led by ``lead``.

    ``rest`` encodes the words of other shapes (a list of texts, ``lead`` included) to runs of ids as bytes.
    """
    memory = pieces_of(path)
    rest = rest or memory.encode
    parts = pc.extract_regex(words, _WORD)
    here = pc.and_kleene(parts.is_valid(), pc.less_equal(pc.binary_length(words), MOST - 2)).fill_null(False)
    plain = here.to_numpy(zero_copy_only=False)
    head, base, tail = (pc.struct_field(parts, k).filter(here) for k in range(3))
    bare = pc.equal(pc.binary_length(head), 0)
    if lead:
        base = pc.if_else(bare, pc.binary_join_element_wise(pa.scalar(lead, base.type), base, pa.scalar("", base.type)), base)
        head = pc.if_else(bare, head, pc.binary_join_element_wise(pa.scalar(lead, head.type), head, pa.scalar("", head.type)))
    base = (pc.utf8_lower(base) if lower else base).dictionary_encode()
    head, tail = head.dictionary_encode(), tail.dictionary_encode()
    other = [lead + x for x in words.filter(pc.invert(here)).to_pylist()]
    marks = [ragged(memory.encode(x.dictionary.to_pylist())) for x in (head, tail)]
    values, bounds, start = pool(byte_words(path).encode(base.dictionary), *marks, ragged(rest(other)), ragged([b""]))
    slots = np.full((len(words), 3), start[4], np.int64)  # the last run is empty
    for column, x, at in ((0, head, start[1]), (1, base, start[0]), (2, tail, start[2])):
        slots[plain, column] = x.indices.to_numpy(zero_copy_only=False).astype(np.int64) + at
    slots[~plain, 1] = start[3] + np.arange(len(other))
    ids, ends = gather(values, bounds, slots.ravel())
    return ids, ends[::3]


def byte_texts(path: str, text: pa.Array, lead: str = "", whole=None) -> tuple[np.ndarray, np.ndarray]:
    """Ids of every text by a byte-level vocabulary without word ends, flat, and bounds; each text is led by ``lead`` (a space or nothing).

    Cut before every single space and around line feeds. Texts with other white space go to the library whole, and texts with a
    special token's string too, unless ``whole`` (text -> ids) reads those as plain text.
    """
    t = tokenizer(path)
    # With a lead, white space at the start makes a run.
    odd = pc.match_substring_regex(text, _ODD_SPACE if not lead else f"^[ \n]|{_ODD_SPACE}").to_numpy(zero_copy_only=False)
    if whole is None:
        odd = odd | has_special(t, text)
    lists = pc.split_pattern(pc.if_else(pa.array(odd), "", text), " ")
    unit_ends = lists.offsets.to_numpy().astype(np.int64)
    unit_ends = unit_ends - unit_ends[0]
    lines = pc.split_pattern(lists.flatten(), "\n")
    ends = lines.offsets.to_numpy().astype(np.int64)
    ends = ends - ends[0]
    subs = lines.flatten()
    spaced, first = np.zeros(len(subs), bool), np.zeros(len(subs), bool)
    first[ends[:-1]] = True
    spaced[ends[:-1]] = True
    if not lead and len(text):
        spaced[ends[unit_ends[:-1]]] = False
    a, b = subs.filter(pa.array(spaced)).dictionary_encode(), subs.filter(pa.array(~spaced)).dictionary_encode()
    rest = None if whole is None else lambda pieces: [whole(x).tobytes() for x in pieces]
    feed = ragged(pieces_of(path).encode(["\n"]))
    values, bounds, start = pool(word_ids(path, a.dictionary, " ", rest=rest), word_ids(path, b.dictionary, rest=rest), feed, ragged([b""]))
    slots = np.empty((len(subs), 2), np.int64)
    slots[:, 0] = np.where(first, start[3], start[2])
    slots[spaced, 1] = a.indices.to_numpy(zero_copy_only=False)
    slots[~spaced, 1] = b.indices.to_numpy(zero_copy_only=False).astype(np.int64) + start[1]
    ids, at = gather(values, bounds, slots.ravel())
    at = at[::2][ends[unit_ends]]
    return whole_texts(t, text, ids, at, odd) if whole is None else other_texts(whole, lead, text, ids, at, odd)


def other_texts(whole, lead: str, text: pa.Array, ids: np.ndarray, bounds: np.ndarray, odd: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The given ids, but with those of the ``odd`` texts by ``whole``."""
    if not odd.any():
        return ids, bounds
    parts = [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    for k in np.flatnonzero(odd):
        parts[k] = whole(lead + text[int(k)].as_py())
    return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])


class PieceWords:
    """Units led by a space by a sentencepiece BPE model: cut before single spaces, since no piece has a space after another character."""

    NORMAL = 0

    def __init__(self, path: str):
        import sentencepiece

        self.sp = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        place = {sp.id_to_piece(k): k for k in range(size) if not (sp.is_byte(k) or sp.is_control(k) or sp.is_unknown(k) or sp.is_unused(k))}
        if any("▁" in p.lstrip("▁") for p in place):
            raise ValueError("a piece of this model goes over a space: units cannot be encoded by themselves")
        # Pieces of spaces alone have one score among them and lie in no unit; the others merge by score, highest first.
        by_score = sorted((p for p in place if len(p) > 1 and p.strip("▁")), key=lambda p: -sp.get_score(place[p]))
        left, right, order = [], [], []
        for rank, p in enumerate(by_score):
            for cut in range(1, len(p)):
                if p[:cut] in place and p[cut:] in place:
                    left.append(place[p[:cut]])
                    right.append(place[p[cut:]])
                    order.append(rank)
        self.merges = Merges(np.array(left), np.array(right), np.array(order), np.array([place[p] for p in by_score]))
        self.symbol = np.full(1 << 16, -1, np.int32)
        for p, k in place.items():
            if len(p) == 1 and ord(p) < 1 << 16 and p != "▁":
                self.symbol[ord(p)] = k
        self.space, feed = place["▁"], sp.piece_to_id("<0x0A>")
        if "\n" not in place and sp.is_byte(feed):
            self.symbol[10] = feed  # a byte piece, which merges with nothing

    def encode_whole(self, text: str) -> np.ndarray:
        return np.array(self.sp.encode(text, num_threads=1), np.uint32)

    def encode(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of different units, each led by a space that is not part of the string."""
        length = pc.utf8_length(units).to_numpy(zero_copy_only=False).astype(np.int64)
        words = units.to_pylist()
        code = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        symbol = np.where(code < 1 << 16, self.symbol[np.minimum(code, (1 << 16) - 1)], -1)
        bounds = np.concatenate([[0], np.cumsum(length)])
        bad = np.concatenate([[0], np.cumsum(symbol < 0)])
        plain = (bad[bounds[1:]] == bad[bounds[:-1]]) & (length < MOST)
        flat, ends = gather(symbol, bounds, np.flatnonzero(plain))
        led = np.insert(flat, ends[:-1], self.space)
        other = [self.encode_whole(words[k]).astype("<u4").tobytes() for k in np.flatnonzero(~plain)]
        values, runs, start = pool(self.merges.encode(led, ends + np.arange(len(ends))), ragged(other))
        place = np.empty(len(words), np.int64)
        place[plain] = np.arange(plain.sum())
        place[~plain] = start[1] + np.arange(len(other))
        return gather(values, runs, place)

    def texts(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of every text, flat, and bounds; empty texts and those with a run of spaces or U+2581 go to the library whole."""
        odd = pc.match_substring_regex(text, "^$|^ |  |▁").to_numpy(zero_copy_only=False)
        lists = pc.split_pattern(pc.if_else(pa.array(odd), "", text), " ")
        ends = lists.offsets.to_numpy().astype(np.int64)
        units = lists.flatten().dictionary_encode()
        ids, at = gather(*self.encode(units.dictionary), units.indices.to_numpy(zero_copy_only=False).astype(np.int64))
        return other_texts(self.encode_whole, "", text, ids, at[ends - ends[0]], odd)


@functools.lru_cache(maxsize=2)
def piece_words(path: str) -> PieceWords:
    return PieceWords(path)
