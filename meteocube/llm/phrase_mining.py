"""Phrase collocation mining by Rabin-Karp fingerprints: count every n-gram by fingerprint, materialise only the frequent ones.

1. Documents are dealt into slices of a few MB. A slice's words are dictionary-encoded; a prefix polynomial over the dictionary's bytes
   hashes its words, a prefix polynomial over the word hashes gives the fingerprint of every n-gram (n from 1 to ``longest``) by one
   subtraction and one multiplication modulo 2^64, and the language is mixed in. Equal fingerprints of a slice are counted there.
2. The shuffle deals the slices' sorted fingerprints with their counts to ranges of fingerprints. An occurrence pointer is an
   entry's place: (slice, range, position). A range adds up the counts and answers each slice with one bit for each entry: is the
   fingerprint frequent in the whole corpus. Collisions can only add to a count, so no frequent phrase is missed; so fingerprints need
   only be as wide as keeps collisions rare, 8 bits more than the text's bytes take to number (``width``), which keeps the shuffle small.
3. Each slice follows its frequent pointers back to its text: the occurrences are grouped by their words, not by fingerprint, and only
   these phrases are written out as text. Adding the counts up by text gives exact frequencies: collisions part here.

Scores and filters are joins over the frequent phrases alone. A frequent phrase is one row for each slice before the shuffle, so
no word or phrase is a hot key; a group is one slice or one range of fingerprints, whose numbers grow with the input.

Defined results: a null text is an empty text (no words); a null language counts as ``und``; repeated rows count each time; a null
doc_id changes nothing (ids are not read); an empty table gives no rows; only ``text`` and ``lang`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meteocube.llm.common import materialize, plain_strings, table

LONGEST = 4
MIN_COUNT = 30
TOP = 2000
COVERED = 80
SCALE = 2_000_000

#: Text in a slice, and text whose fingerprints meet in one range; at least ``LEAST`` of both.
SLICE_TEXT = 8 << 20
RANGE_TEXT = 4 << 20
LEAST = 64

_U = np.uint64
_BYTE_BASE, _WORD_BASE = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95  # odd, so that they have inverses modulo 2^64


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> _U(31))) * _U(0x7FB5D329728EA185)
    x = (x ^ (x >> _U(27))) * _U(0x81DADEF4BC2DD44D)
    return x ^ (x >> _U(33))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, _U)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=_U)


class Polynomial:
    """Prefix sums of value[j] * base^j, from which the hash of any run does not depend on its place."""

    def __init__(self, values: np.ndarray, base: int):
        self.prefix = np.concatenate([np.zeros(1, _U), np.cumsum(values * _powers(base, len(values)), dtype=_U)])
        self.back = _powers(pow(base, -1, 1 << 64), len(values) + 1)

    def runs(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.prefix[end] - self.prefix[start]) * self.back[start]


_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*map(ord, ".,;:!?"), 0x0A, 0x0B, 0x0C, 0x0D]] = 2


@dataclass
class Slice:
    """Words of some texts: their dictionary, and for each word its dictionary place, its piece and its language."""

    dictionary: pa.Array
    idx: np.ndarray
    piece: np.ndarray
    lang: np.ndarray
    langs: list[str]

    @classmethod
    def of(cls, text: pa.Array, lang: pa.Array) -> Slice:
        text = pc.ascii_lower(plain_strings(text))
        bounds = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
        raw = np.frombuffer(text.buffers()[2], np.uint8)[bounds[0] : bounds[-1]] if bounds[-1] > bounds[0] else np.zeros(0, np.uint8)
        bounds = bounds - bounds[0]
        names = pc.fill_null(lang.combine_chunks() if isinstance(lang, pa.ChunkedArray) else lang, "und").dictionary_encode()
        kind = _KIND[raw]
        inside = kind == 0
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        at = bounds[:-1][np.diff(bounds) > 0]
        first[at] = inside[at]  # a word ends with its text
        at = bounds[1:][np.diff(bounds) > 0] - 1
        last[at] = inside[at]
        starts = np.flatnonzero(first)
        offsets = np.concatenate([[0], np.cumsum(np.flatnonzero(last) + 1 - starts)]).astype(np.int64)
        words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(raw[inside])).dictionary_encode()
        doc = np.searchsorted(bounds, starts, side="right") - 1
        return cls(words.dictionary, words.indices.to_numpy(zero_copy_only=False).astype(np.int64), np.cumsum(kind == 2)[starts] + doc,
                   names.indices.to_numpy(zero_copy_only=False).astype(np.int64)[doc], names.dictionary.to_pylist())

    def word_hashes(self) -> np.ndarray:
        words = self.dictionary
        if not len(words):
            return np.zeros(0, _U)
        bounds = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
        raw = np.frombuffer(words.buffers()[2], np.uint8)[bounds[0] : bounds[-1]]
        return _mix(Polynomial(raw.astype(_U) + _U(1), _BYTE_BASE).runs(bounds[:-1] - bounds[0], bounds[1:] - bounds[0]))

    def fingerprints(self, longest: int, shift: int = 0) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(n, starts, fingerprints) of the n-grams of every length; the lowest ``shift`` bits are dropped (zero)."""
        hashes = self.word_hashes()
        line = Polynomial(hashes[self.idx] if len(self.idx) else hashes, _WORD_BASE)
        codes = pa.array(self.langs, pa.large_string())
        of_lang = Slice(codes, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), []).word_hashes()
        for n in range(1, longest + 1):
            at = np.arange(max(0, len(self.idx) - n + 1))
            at = at[self.piece[at] == self.piece[at + n - 1]] if len(at) else at
            yield n, at, _mix(line.runs(at, at + n) ^ of_lang[self.lang[at]] if len(at) else np.zeros(0, _U)) >> _U(shift) << _U(shift)

    def entries(self, longest: int, shift: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Different fingerprints in ascending order, and their counts."""
        found = np.sort(np.concatenate([x for _, _, x in self.fingerprints(longest, shift)]))
        new = np.ones(len(found), bool)
        new[1:] = found[1:] != found[:-1]
        at = np.flatnonzero(new)
        return found[at], np.diff(np.append(at, len(found)))

    def phrases(self, frequent: np.ndarray, longest: int, shift: int = 0) -> Iterator[tuple[int, pa.Array, pa.Array, np.ndarray]]:
        """(n, languages, phrases, counts) of the n-grams with a ``frequent`` (sorted) fingerprint, told apart by their words."""
        likely = np.ones(len(self.idx) + 1, bool)  # word places where a frequent phrase of n - 1 words starts
        for n, at, found in self.fingerprints(longest, shift):
            # Both parts of a frequent phrase that are one word shorter are frequent.
            maybe = likely[at] & likely[at + 1] if n > 1 else np.ones(len(at), bool)
            at, found = at[maybe], found[maybe]
            if n == 1:  # looked up once for each word and language
                _, one, word = np.unique(self.lang * len(self.dictionary) + self.idx, return_index=True, return_inverse=True)
                at = at[_among(found[one], frequent)[word]]
            else:
                at = at[_among(found, frequent)]
            likely = np.zeros(len(self.idx) + 1, bool)
            likely[at] = True
            if not len(at):
                continue
            width = len(self.dictionary)
            key = self.lang[at] * width + self.idx[at]
            for k in range(1, n):
                key = np.unique(key, return_inverse=True)[1] * width + self.idx[at + k]
            _, one, counts = np.unique(key, return_index=True, return_counts=True)
            one = at[one]
            words = [self.dictionary.take(pa.array(self.idx[one + k])) for k in range(n)]
            text = pc.binary_join_element_wise(*words, pa.scalar(" ", pa.large_string()))
            yield n, pa.array(self.langs, pa.string()).take(pa.array(self.lang[one])), text, counts


def _among(found: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """Which are in the sorted array ``frequent``."""
    if not len(frequent):
        return np.zeros(len(found), bool)
    return frequent[np.minimum(np.searchsorted(frequent, found), len(frequent) - 1)] == found


# --- fingerprints on the wire: differences and counts less one, by byte planes, so that the shuffle's compression drops the zeros ---


def planes(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()


def unplaned(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).ravel()


def width(size: int) -> int:
    """Bits of a fingerprint for so many bytes of text: a phrase meets another one by chance in about 1 of 256 cases at most."""
    return min(64, max(32, int(max(1, size) - 1).bit_length() + 8))


def range_bounds(found: np.ndarray, ranges: int) -> np.ndarray:
    """Bounds of the ``ranges`` equal ranges of fingerprints in a sorted array."""
    return np.searchsorted((found >> _U(40)) * _U(ranges) >> _U(24), np.arange(ranges + 1).astype(_U))


def _slices(docs: DataFrame) -> tuple[DataFrame, int]:
    """(slice, lang, text) of every document with a text, written once, and the texts' bytes."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text").where(F.octet_length("text") > 0)
    rows = materialize(rows.withColumn("size", F.octet_length("text").cast("long")), "phrase-texts")
    size = rows.agg(F.sum("size")).first()[0] or 0
    return rows.select(F.pmod(F.xxhash64("row"), F.lit(max(LEAST, size // SLICE_TEXT))).alias("slice"), "lang", "text"), size


def frequent_phrases(docs: DataFrame, longest: int = LONGEST, min_count: int = MIN_COUNT) -> DataFrame:
    """(lang, n, phrase, count) of every phrase of up to ``longest`` words that occurs ``min_count`` times in its language.

    Rows with n = 0 hold the language's number of word occurrences.
    """
    rows, size = _slices(docs)
    ranges = int(min(1 << 24, max(LEAST, size // RANGE_TEXT)))
    shift = 64 - width(size)

    def count(t: pa.Table) -> pa.Table:
        found, counts = Slice.of(t["text"], t["lang"]).entries(longest, shift)
        cuts = range_bounds(found, ranges)
        some = np.flatnonzero(np.diff(cuts))
        steps = [planes(np.diff(found[cuts[r] : cuts[r + 1]], prepend=_U(0)) >> _U(shift)) for r in some]
        often = [planes((counts[cuts[r] : cuts[r + 1]] - 1).astype(np.uint32)) for r in some]
        return pa.table({"slice": pa.array(np.full(len(some), t["slice"][0].as_py())), "range": pa.array(some), "steps": pa.array(steps, pa.binary()), "often": pa.array(often, pa.binary())})

    def judge(t: pa.Table) -> pa.Table:
        parts = [np.cumsum(unplaned(x.as_py(), _U), dtype=_U) << _U(shift) for x in t["steps"]]
        found = np.concatenate(parts)
        counts = np.concatenate([unplaned(x.as_py(), np.uint32) for x in t["often"]]).astype(np.int64) + 1
        order = np.argsort(found, kind="stable")
        found = found[order]
        at = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]]))
        enough = np.add.reduceat(counts[order], at) >= min_count
        flag = np.zeros(len(found), bool)
        flag[order] = np.repeat(enough, np.diff(np.append(at, len(found))))
        ends = np.cumsum([len(p) for p in parts])
        bits = [np.packbits(flag[e - len(p) : e]).tobytes() for p, e in zip(parts, ends, strict=True)]
        return pa.table({"slice": t["slice"], "range": t["range"], "bits": pa.array(bits, pa.binary())})

    def tell(texts: pa.Table, bits: pa.Table) -> pa.Table:
        part = Slice.of(texts["text"], texts["lang"])
        found, _ = part.entries(longest, shift)
        cuts = range_bounds(found, ranges)
        flag = np.zeros(len(found), bool)
        for r, b in zip(bits["range"].to_pylist(), bits["bits"].to_pylist(), strict=True):
            flag[cuts[r] : cuts[r + 1]] = np.unpackbits(np.frombuffer(b, np.uint8), count=cuts[r + 1] - cuts[r]).astype(bool)
        words = np.bincount(part.lang, minlength=len(part.langs))
        out = [(0, pa.array(part.langs, pa.string()), pa.array([""] * len(part.langs), pa.string()), words), *part.phrases(found[flag], longest, shift)]
        return pa.concat_tables([pa.table({"lang": lang, "n": pa.array(np.full(len(counts), n, np.int32)), "phrase": text.cast(pa.string()), "count": pa.array(counts.astype(np.int64))}) for n, lang, text, counts in out])

    entries = rows.groupBy("slice").applyInArrow(count, "slice long, range long, steps binary, often binary")
    # A group is one range of fingerprints: entries of about RANGE_TEXT of text.
    # Written, so that the fingerprints' shuffle files can go before the texts are dealt again.
    bits = materialize(entries.groupBy("range").applyInArrow(judge, "slice long, range long, bits binary"), "phrase-bits")
    told = rows.groupBy("slice").cogroup(bits.groupBy("slice")).applyInArrow(tell, "lang string, n int, phrase string, count long")
    total = told.groupBy("lang", "n", "phrase").agg(F.sum("count").alias("count"))
    return materialize(total.where((F.col("n") == 0) | (F.col("count") >= min_count)), "phrases")


def _exact(c: str) -> F.Column:
    return F.col(c).cast("decimal(20,0)")


def collocations(frequent: DataFrame, top: int = TOP, covered: int = COVERED) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's first ``top`` phrases of two or more words."""
    counted = frequent.select("lang", "n", "phrase", F.col("count").alias("a"))
    many = counted.where(F.col("n") >= 2).withColumn("words", F.split("phrase", " "))

    # Counts of both parts of every cut. A part that begins many phrases is a hot key of one small table: AQE splits it.
    cut = many.select("lang", "phrase", "a", "words", "n", F.explode(F.sequence(F.lit(1), F.col("n") - 1)).alias("k"))
    cut = cut.select("lang", "phrase", "a", "k", F.array_join(F.slice("words", 1, F.col("k")), " ").alias("first"), F.array_join(F.slice("words", F.col("k") + 1, F.col("n") - F.col("k")), " ").alias("rest"))
    part = lambda name, count: counted.where(F.col("n") > 0).select(F.col("lang").alias(f"_{count}"), F.col("phrase").alias(name), F.col("a").alias(count))
    cut = cut.join(part("first", "l").withColumnRenamed("_l", "lang"), ["lang", "first"]).join(part("rest", "r").withColumnRenamed("_r", "lang"), ["lang", "rest"])
    # Exact: the product may pass 64 bits, so it is a decimal; the quotient is at most SCALE.
    score = F.expr(f"(cast(a as decimal(20,0)) * cast({SCALE} as decimal(10,0))) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    best = cut.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("c"))

    # The largest count of a longer candidate around each phrase.
    spans = F.flatten(F.transform(F.sequence(F.lit(2), F.col("n") - 1), lambda m: F.transform(F.sequence(F.lit(1), F.col("n") - m + 1), lambda i: F.array_join(F.slice("words", i, m), " "))))
    around = many.where(F.col("n") >= 3).select("lang", "a", F.explode(spans).alias("phrase")).groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = best.join(around, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (_exact("longer") * 100 < _exact("a") * covered))

    # A language may hold most of the phrases: each of 64 shares hands on its first ``top``.
    kept = kept.select("lang", "phrase", "a", F.col("c.l").alias("l"), F.col("c.r").alias("r"), F.col("c.score").alias("score"))
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    share = F.row_number().over(W.partitionBy("lang", "share").orderBy(*order))
    kept = kept.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(64))).withColumn("at", share).where(F.col("at") <= top).drop("share", "at")
    kept = kept.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    words = counted.where(F.col("n") == 0).select("lang", F.col("a").alias("n"))
    return kept.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(frequent_phrases(table(spark, sf_dir, "documents")))


ORACLE_SQL = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
sizes AS (SELECT lang, sum(len(w))::BIGINT AS n FROM worded GROUP BY lang),
grams AS (
  SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase
  FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM worded, (SELECT unnest(range(1, {LONGEST + 1})) AS m) WHERE len(w) >= m)),
f AS (SELECT lang, m, phrase, count(*)::HUGEINT AS a FROM grams GROUP BY ALL HAVING count(*) >= {MIN_COUNT}),
cand AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE m >= 2),
cuts AS (SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS p, array_to_string(w[k + 1:], ' ') AS q FROM (SELECT *, unnest(range(1, m)) AS k FROM cand)),
scored AS (
  SELECT cuts.lang, cuts.phrase, cuts.a, k, x.a AS l, y.a AS r, ({SCALE} * cuts.a) // (x.a + y.a) AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = p JOIN f y ON y.lang = cuts.lang AND y.phrase = q),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
around AS (
  SELECT lang, array_to_string(w[i:i + s - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT *, unnest(range(1, m - s + 2)) AS i FROM (SELECT *, unnest(range(2, m)) AS s FROM cand WHERE m >= 3)) GROUP BY ALL),
kept AS (
  SELECT best.* FROM best LEFT JOIN around USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < {COVERED} * a)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) JOIN sizes USING (lang)
WHERE rank <= {TOP}
"""
