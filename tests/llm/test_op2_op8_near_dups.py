import math
import random

import numpy as np
import pytest
import xxhash
from llm_helpers import EDGE, docs_df, prose, ship

from meteocube.llm import embed_pivots as e
from meteocube.llm import graph
from meteocube.llm import simhash_bytes as s


def union(n, pairs):
    root = list(range(n))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(k) for k in range(n)]


# --- embeddings ---


def cosine_links(vectors, threshold=0.9):
    ok = [v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v) for v in vectors]
    dim = max([len(v) for v, k in zip(vectors, ok) if k], default=0)
    m = np.array([[*v, *[0.0] * (dim - len(v))] if k else [0.0] * dim for v, k in zip(vectors, ok)])
    m /= np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)
    c = m @ m.T
    return [(i, j) for i in range(len(vectors)) for j in range(i) if ok[i] and ok[j] and c[i, j] >= threshold]


def frame(spark, rows):
    ship(spark)
    return spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, n string, rid int")


def test_groups_match_brute_force(spark):
    rng = np.random.default_rng(3)
    rows, k = [], 0
    for c in range(60):
        centre = rng.normal(size=24)
        for _ in range(1 + c % 4 * 3):
            rows.append((k, (centre + rng.normal(scale=0.12, size=24)).astype(np.float32).tolist()))
            k += 1
    rows += [(k + j, rows[5][1]) for j in range(6)]
    k += 6
    rows += [(k, None), (k + 1, []), (k + 2, [0.0] * 24), (k + 3, [1.0, None, 2.0]), (k + 4, [float("nan")] * 24), (k + 5, [float("inf"), 1.0]), (k + 6, [1.0] * 24), (k + 7, [-2.0] * 24), (k + 8, [3.0] * 24)]
    got = {r.vec_id: r for r in e.near_duplicates(frame(spark, rows)).collect()}
    links = cosine_links([v for _, v in rows])
    root = union(len(rows), links)
    degree = [sum(k in p for p in links) for k in range(len(rows))]
    found = sum(r.n_links for r in got.values())
    assert found >= 0.97 * 2 * len(links) and all(got[k].n_links <= degree[k] for k in got)
    assert np.mean([got[k].component_id == root[k] for k in got]) >= 0.97
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())
    assert all(got[j].n_links == 0 and got[j].kept for j in range(k, k + 6))


def test_long_lists_are_met_in_blocks_without_losing_or_repeating_links(spark):
    rng = np.random.default_rng(4)
    centre = rng.normal(size=16)
    rows = [(k, (centre + rng.normal(scale=0.05, size=16)).astype(np.float32).tolist()) for k in range(300)]
    got = e.near_duplicates(frame(spark, rows), e.Settings(block=32)).collect()
    links = cosine_links([v for _, v in rows])
    assert sum(r.n_links for r in got) == 2 * len(links)
    assert {r.component_id for r in got} == {0}


def test_null_ids_repeated_rows_and_empty_table(spark):
    v = [1.0, 2.0, 3.0]
    got = e.near_duplicates(frame(spark, [(4, v), (4, v), (None, v), (None, None), (9, [-1.0, 0.0, 0.5])])).collect()
    key = sorted((str(r.vec_id), r.n_links, r.component_id, r.kept) for r in got)
    assert key == sorted([("4", 2, 4, True), ("4", 2, 4, True), ("None", 2, 4, False), ("None", 0, None, False), ("9", 0, 9, True)])
    assert e.near_duplicates(frame(spark, []).limit(0)).count() == 0


def test_pivots_keep_apart():
    x = np.array([[1.0, 0], [0.999, 0.0447], [0, 1.0]])
    assert len(e.choose_pivots(x, 3, 0.8)) == 2
    assert e.pivot_count(10**12, e.Settings()) == e.MAX_PIVOTS


def test_links_are_found_among_many_pivots(spark):
    rng = np.random.default_rng(12)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    x = unit(rng.normal(size=(2400, 64)))
    off = rng.normal(size=(600, 64))
    off = unit(off - (off * x[:600]).sum(1, keepdims=True) * x[:600])
    m = np.concatenate([x, 0.905 * x[:600] + np.sqrt(1 - 0.905**2) * off])
    rows = [(k, v) for k, v in enumerate(m.astype(np.float32).tolist())]
    got = e.near_duplicates(frame(spark, rows), e.Settings(pivots_per_root=38)).collect()  # 2,048 pivots
    links = cosine_links([v for _, v in rows])
    assert len(links) >= 600 and sum(r.n_links for r in got) >= 0.97 * 2 * len(links)


@pytest.mark.parametrize("kind", ["float", "double"])
def test_pairs_around_the_threshold_are_decided_by_whole_vectors_and_counted_once(spark, kind):
    rng = np.random.default_rng(14)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    centre = unit(rng.normal(size=(1, 48)))
    off = rng.normal(size=(220, 48))
    m = math.sqrt(0.9) * centre + math.sqrt(0.1) * unit(off - (off @ centre.T) * centre)  # cosines spread about 0.9
    rows = [(k, v, "x", 1) for k, v in enumerate(m.astype(np.float32 if kind == "float" else np.float64).tolist())]
    ship(spark)
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, n string, rid int")
    settings = e.Settings(block=32, prefix=16, shared=1)  # as many pivots as there are: every pair meets
    got = {r.vec_id: r for r in e.near_duplicates(df, settings).collect()}
    links = cosine_links([r[1] for r in rows])
    root = union(len(rows), links)
    assert len(links) > 5000 and sum(0.89 < m[i] @ m[j] < 0.91 for i, j in links) > 1000
    assert [got[k].n_links for k in got] == [sum(k in p for p in links) for k in got]
    assert all(got[k].component_id == root[k] for k in got)


def test_bytes_bound_the_error_of_a_cosine():
    rng = np.random.default_rng(15)
    x = rng.standard_t(2, size=(300, 40))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    code, scale, lost = e._codes(x)
    back = code * scale[:, None].astype(np.float64)
    slack = lost[:, None] + lost[None] + lost[:, None] * lost[None]
    assert (np.abs(back @ back.T - x @ x.T) <= slack + 1e-6).all()


def test_prefix_holds_recall_at_every_number_of_pivots():
    rng = np.random.default_rng(13)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    x, off = unit(rng.normal(size=(400, 64))), rng.normal(size=(400, 64))
    y = 0.9 * x + np.sqrt(1 - 0.9**2) * unit(off - (off * x).sum(1, keepdims=True) * x)
    s = e.Settings()
    for count in (16, 256, 1024, 4096, e.MAX_PIVOTS):
        pivots = unit(rng.normal(size=(count, 64)))
        a, b = (e._permutations(z, pivots, e.prefix_length(count, s)) for z in (x, y))
        assert np.mean((a[:, :, None] == b[:, None, :]).sum((1, 2)) >= s.shared) >= 0.97, count


# --- components ---


def test_components_of_paths_stars_and_cycles(spark):
    ship(spark)
    rng = random.Random(5)
    pairs = [(k, k + 1) for k in range(0, 200)] + [(500, 500 + k) for k in range(1, 300)] + [(900, 901), (901, 902), (902, 900), (950, 950)]
    pairs += [(1000 + rng.randrange(300), 1000 + rng.randrange(300)) for _ in range(160)]
    rng.shuffle(pairs)
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    root = union(1400, pairs)
    nodes = {x for p in pairs if p[0] != p[1] for x in p}
    assert got == {k: root[k] for k in nodes}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_pairs_of_groups_meet_once():
    lo, hi, side = np.array([0, 0, 0, 0, 0, 1, 1]), np.array([0, 0, 0, 1, 1, 1, 1]), np.array([0, 0, 0, 0, 1, 0, 0])
    bounds = np.array([0, 3, 5, 7])
    for at_once in (1, 3, 100):
        found = [(int(i), int(j)) for a, b in graph.pairs_in_groups(bounds, lo, hi, side, at_once) for i, j in zip(a, b)]
        assert found == [(0, 1), (0, 2), (1, 2), (3, 4), (5, 6)]


# --- SimHash ---


def simhash(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    counts = [0] * 64
    for x in shingles:
        h = xxhash.xxh64(x, seed=42).intdigest()
        for k in range(64):
            counts[k] += h >> k & 1
    return sum(1 << k for k in range(64) if 2 * counts[k] > len(shingles))


def test_fingerprints_match_brute_force_and_spark(spark):
    for _, t in EDGE:
        assert s.fingerprint((t or "").encode()) % 2**64 == simhash(t)
    one = docs_df(spark, [(1, "ÀB Cd EF")]).selectExpr("xxhash64('Àb cd ef') as h")  # only A-Z change their case
    got = s.fingerprints(docs_df(spark, [(1, "ÀB Cd EF".replace("À", "À"))])).first().fp
    assert one.first().h == got


@pytest.fixture(scope="module")
def near(spark):
    rng = random.Random(6)
    base = [prose(160, 13 * k).split() for k in range(40)]
    rows = []
    for k in range(260):
        words = list(base[k % 40])
        if k >= 40:
            for _ in range(rng.randrange(3)):
                words[rng.randrange(len(words))] = f"w{rng.randrange(1000)}"
        rows.append((k * 3 + 1, " ".join(words)))
    return [(900 + i if i is not None else None, t) for i, t in EDGE] + rows


def classes_of(rows):
    fp = [simhash(t) for _, t in rows]
    return fp, union(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if (fp[i] ^ fp[j]).bit_count() <= 3])


def test_classes_match_brute_force(spark, near):
    docs = docs_df(spark, near, fp="f", key="k", root="r", node="n")
    got = sorted((str(r.doc_id), r.fp % 2**64, r.component_id) for r in s.classes(docs).collect())
    fp, root = classes_of(near)
    low = {}
    for (i, _), r in zip(near, root):
        low[r] = min((x for x in (low.get(r), i) if x is not None), default=None)
    assert got == sorted((str(i), f, low[r]) for (i, _), f, r in zip(near, fp, root))
    assert len(set(root)) < len(near) - 50


def test_index_lists_every_pair_within_three_bits():
    rng = random.Random(7)
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for p in rng.sample(range(64), 3):
            b ^= 1 << p
        byte = lambda x, p: x >> 8 * p & 255
        assert any(all(byte(a, p) == byte(b, p) for p in t) for t in s.TRIPLES)


def test_links_in_small_blocks_equal_brute_force(spark):
    ship(spark)
    rng = random.Random(8)
    core = [rng.getrandbits(64) for _ in range(4)]
    fps = sorted({c ^ sum(1 << p for p in rng.sample(range(64), rng.randrange(4))) for c in core for _ in range(120)})
    signed = [x - 2**64 if x >= 2**63 else x for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    root = graph.components(s.fingerprint_links(df)).collect()
    want = union(len(fps), [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3])
    groups = {}
    for r in root:
        groups.setdefault(r.root, set()).add(r.node)
    expect = {}
    for k, r in enumerate(want):
        expect.setdefault(r, set()).add(signed[k])
    assert sorted(map(sorted, groups.values())) == sorted(sorted(g) for g in expect.values() if len(g) > 1)
    with pytest.raises(ValueError):
        s.fingerprint_links(df, 4)


def test_keep_leaves_one_row_of_each_group(spark, near):
    docs = docs_df(spark, near, fp="f", _fp2="x")
    kept = s.keep(docs)
    assert kept.columns == docs.columns
    got = [r.doc_id for r in kept.collect()]
    _, root = classes_of(near)
    low = {}
    for (i, _), r in zip(near, root):
        low[r] = min((x for x in (low.get(r), i) if x is not None), default=None)
    assert sorted(map(str, got)) == sorted(str(v) for v in low.values())
    assert s.keep(docs.limit(0)).count() == 0 and s.classes(docs.limit(0)).count() == 0


def test_keep_tells_groups_apart_that_share_an_id(spark):
    a, b = prose(120, 501), prose(120, 777)
    near_a = a + " end"
    c = prose(120, 333)
    for rows in ([(5, a), (5, b)], [(5, a), (3, b), (5, b)], [(5, b), (3, b), (5, a)], [(5, a), (5, a), (5, b), (None, c), (5, b)], [(5, a), (5, near_a), (7, b), (7, a)]):
        fp, root = classes_of(rows)
        kept = [(r.doc_id, r.text) for r in s.keep(docs_df(spark, rows)).collect()]
        of = {t: r for (_, t), r in zip(rows, root)}
        assert sorted(of[t] for _, t in kept) == sorted(set(root))  # one row of each group
        for i, t in kept:
            ids = [x for (x, _), r in zip(rows, root) if r == of[t] and x is not None]
            assert i == min(ids, default=None)
