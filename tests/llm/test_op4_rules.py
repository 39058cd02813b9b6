import re
from collections import Counter

import duckdb
from llm_helpers import EDGE, docs_df, prose

from meteocube.llm import rules_ledger as r

ROWS = [
    *EDGE,
    (20, "a b c a b c " * 30),
    (21, "a a a a"),
    (22, "a b a b a b"),
    (23, prose(60) + " " + prose(60)),
    (24, "#x *y $z %q &w |e <r> " * 10),
    (25, "same\n" * 40 + prose(60)),
    (26, "x y\n x y\nx y"),
]


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    marked = {p for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] >= 2 for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(marked), len(lines)


def test_measures_match_brute_force(spark):
    got = r.ledger(docs_df(spark, ROWS, n_words="n", failed="f", part="p")).collect()
    want = sorted([(str(i), *brute(t)) for i, t in ROWS])
    assert sorted((str(g.doc_id), *[g[m] for m in r.MEASURES]) for g in got) == want


def test_bits_are_the_rules_and_policies_read_them(spark):
    for g in r.ledger(docs_df(spark, ROWS)).withColumn("ok", r.verdict(r.POLICIES["v1"])).collect():
        m = {k: g[k] for k in r.MEASURES}
        fails = [eval(rule, {}, m) for _, rule in r.RULES]
        assert g.failed == sum(1 << k for k, f in enumerate(fails) if f)
        assert g.ok == (not any(f and r.POLICIES["v1"] >> k & 1 for k, f in enumerate(fails)))


def test_query_and_ablation_match_sql(spark, tmp_path):
    docs = docs_df(spark, ROWS)
    con = duckdb.connect()
    con.register("rows", docs.toPandas())
    con.sql("create view documents as select cast(doc_id as bigint) as doc_id, text from rows")
    want = con.sql(r.ABLATION_SQL).fetchall()
    names = ["policy", "rule", "n_failed", "n_only_this", "n_kept"]
    got = [tuple(x) for x in r.ablation(r.ledger(docs)).select(*names).collect()]
    assert sorted(got) == sorted(want)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    out = r.op4_rules_ledger(spark, str(tmp_path))
    rel = con.sql(r.ORACLE_SQL)
    key = lambda t: tuple(str(int(x)) if isinstance(x, (bool, float, int)) and x == x else str(x) for x in t)
    got = sorted(key(x) for x in out.select(*rel.columns).collect())
    assert got == sorted(key(x) for x in rel.fetchall())


def test_keep_takes_whole_rows(spark):
    docs = docs_df(spark, ROWS, n_words="mine", failed="too", _held_0="x")
    kept = r.keep(docs)
    assert kept.columns == docs.columns and {x.n_words for x in kept.collect()} == {"mine"}
    ok = {str(g.doc_id) for g in r.ledger(docs).where(r.verdict(r.POLICIES[r.CURRENT])).collect()}
    assert {str(x.doc_id) for x in kept.collect()} == ok and {"1", "6", "7", "None"} <= ok and not {"20", "24", "2"} & ok
    assert r.keep(docs.limit(0)).count() == 0 and r.ledger(docs.limit(0)).count() == 0
    assert r.ablation(r.ledger(docs.limit(0))).count() == 0
