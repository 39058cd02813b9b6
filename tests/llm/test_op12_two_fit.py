"""Best-two-fit packing: every id once, gapless, by the library's ids; the plan against an item-by-item version."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_helpers import EDGE, docs_df, prose
from tokenizers import Tokenizer

from meteocube.llm import best_two_fit as bt
from meteocube.llm.tokens import BYTE_BPE, vocabulary

PATH = vocabulary(BYTE_BPE)


def one_by_one(lengths, capacity):
    """Best-two-fit, one bin at a time, over single items."""
    left = Counter(lengths)
    bins = []
    while left:
        room, held, gap = left.copy(), [], capacity
        while fit := [n for n in room if n <= gap and room[n]]:
            held.append(max(fit))
            room[held[-1]] -= 1
            gap -= held[-1]
        while gap and len(held) > 1:
            small = min(held)
            free = sorted(room.elements())
            pairs = [(x + y, y, x) for i, x in enumerate(free) for y in free[i + 1 :] if x + y <= gap + small]
            if not pairs or max(pairs)[0] <= small:
                break
            total, y, x = max(pairs)
            held.remove(small)
            held += [x, y]
            room[small] += 1
            room[x] -= 1
            room[y] -= 1
            gap -= total - small
        bins.append(sorted(held, reverse=True))
        left = +(left - Counter(held))
    return bins


@pytest.mark.parametrize("seed", range(6))
def test_plan_equals_one_bin_at_a_time(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 17, 40])
    lengths = [rng.randint(1, capacity) for _ in range(60)] + [capacity // 3 + 1] * 9
    plan = bt.plan_bins(np.bincount(lengths, minlength=capacity + 1), capacity)
    bins = [c for c, t in zip(plan.contents, plan.times, strict=True) for _ in range(t)]
    assert sorted(sum(bins, [])) == sorted(lengths) and all(sum(b) <= capacity for b in bins)
    assert sorted(bins) == sorted(one_by_one(lengths, capacity))


def test_two_fit_beats_greedy():
    # Greedy: 6+3 leaves a gap of 1; 3 goes out for 2+2.
    plan = bt.plan_bins(np.bincount([6, 3, 2, 2, 7], minlength=11), 10)
    assert sorted(plan.contents) == [[6, 2, 2], [7, 3]]


def test_many_items_near_the_lower_bound():
    rng = np.random.default_rng(3)
    lengths = rng.integers(1, 1025, 200_000)
    plan = bt.plan_bins(np.bincount(lengths, minlength=1025))
    assert -(-lengths.sum() // 1024) <= plan.bins <= 1.001 * lengths.sum() / 1024
    at = plan.segments()
    assert len(at["length"]) < 20 * 1024


def check(rows, docs, capacity):
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    want = Counter()
    for d, text in docs:
        ids = t.encode(text or "", add_special_tokens=False).ids + [2]
        first = len(ids) % capacity or capacity
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            want[d, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert sorted(held) == list(range(len(held)))
    return len(held)


@pytest.mark.parametrize("capacity", [1024, 50, 1])
def test_every_id_lies_in_one_piece(spark, capacity):
    docs = [*EDGE, *[(100 + k, prose(k % 90, k)) for k in range(150)], *[(500, prose(12, 1))] * 80]
    if capacity == 1:
        docs = docs[:4] + docs[-3:]
    packed = bt.pack(docs_df(spark, docs, length="x", part="y", slot="z", n="n").repartition(4), PATH, capacity=capacity)
    n = check(bt.digest(packed).collect(), docs, capacity)
    whole = bt.sequences(packed)
    assert whole.count() == n and max(len(r.ids) for r in whole.collect()) <= 4 * capacity


def test_the_join_that_shuffles_gives_the_same(spark, monkeypatch):
    docs = [(k, prose(k % 60, k)) for k in range(80)]
    monkeypatch.setattr(bt, "MOST_BROADCAST", 0)
    check(bt.digest(bt.pack(docs_df(spark, docs).repartition(3), PATH)).collect(), docs, 1024)


def test_empty_table(spark):
    assert bt.digest(bt.pack(docs_df(spark, []), PATH)).collect() == []
    with pytest.raises(ValueError):
        bt.pack(docs_df(spark, []), PATH, capacity=0)
