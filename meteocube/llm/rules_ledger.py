"""Quality rules: a ledger of failure bits and measurements, versioned policies over it, ablations by bit sums.

``ledger`` measures every text once and evaluates every rule once: a row keeps its measurements and a long whose
bit k is set when rule k fails. A policy is a named mask of rules that must hold; applying another policy, or
asking what a rule removes, reads the ledger's bits and never the texts.

Defined results: a null text has no words, so it is like an empty text (all measurements 0, ``few_words`` fails);
equal texts get equal bits; repeated rows each give a row; an empty table gives an empty ledger; only ``doc_id``
and ``text`` are read, so further columns cannot clash (``keep`` returns them untouched).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meteocube.llm import textstats as ts
from meteocube.llm.common import fresh, table, text_slices

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")

#: Rules in bit order: (name, SQL condition under which it fails). Only append: stored bits keep their meaning.
RULES = (
    ("few_words", "n_words < 50"),
    ("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 20 * n_words"),
    ("symbols", "100 * n_symbols > 25 * n_words"),
    ("repeated_lines", "100 * n_dup_lines > 60 * n_lines"),
)
BIT = {name: 1 << k for k, (name, _) in enumerate(RULES)}

#: Policies by version: the rules that must hold.
POLICIES = {
    "base": BIT["few_words"] | BIT["repeated_words"],
    "v1": BIT["few_words"] | BIT["repeated_words"] | BIT["short_words"] | BIT["long_words"] | BIT["symbols"],
    "v2": (1 << len(RULES)) - 1,
}
CURRENT = "v2"


def measure(text: pa.Array) -> dict[str, np.ndarray]:
    w = ts.words(text)
    lines, dup = ts.duplicate_lines(text)
    symbols = pc.count_substring_regex(text, ts.SYMBOLS).to_numpy(zero_copy_only=False)
    values = (w.counts, w.per_doc(ts.word_chars(w)), symbols, dup, ts.repeated_window_words(w), lines)
    return {name: np.asarray(v).astype(np.int64) for name, v in zip(MEASURES, values, strict=True)}


def failures() -> F.Column:
    """Bits of the rules that fail."""
    bits = [F.when(F.expr(rule), F.lit(1 << k)).otherwise(F.lit(0)).cast("long") for k, (_, rule) in enumerate(RULES)]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, the measurements and ``failed`` (bits) for every row; one pass, no shuffle."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, text in text_slices(batches, "text"):
            m = measure(text)
            yield pa.RecordBatch.from_arrays([rows.column(0), *[pa.array(m[k]) for k in MEASURES]], names=["doc_id", *MEASURES])

    schema = "doc_id long, " + ", ".join(f"{m} long" for m in MEASURES)
    measured = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(task, schema)
    return measured.withColumn("failed", failures())


def verdict(mask: int) -> F.Column:
    """Whether a ledger row keeps every rule of the mask."""
    return F.col("failed").bitwiseAND(F.lit(mask).cast("long")) == 0


def ablation(rows: DataFrame, policies: dict[str, int] = POLICIES) -> DataFrame:
    """policy, rule, rows that it fails, rows that the policy drops for this rule alone, rows that it keeps.

    The ledger is first counted by bit pattern (at most 2 ** rules groups, summed before the shuffle); all
    policies and rules are then bit arithmetic over those counts.
    """
    patterns = rows.groupBy("failed").agg(F.count(F.lit(1)).alias("n"))
    asked = [(p, m, name, BIT[name]) for p, m in policies.items() for name, _ in RULES if m & BIT[name]]
    fields = [F.struct(F.lit(p).alias("policy"), F.lit(m).cast("long").alias("mask"), F.lit(r).alias("rule"), F.lit(b).cast("long").alias("bit")) for p, m, r, b in asked]
    met = patterns.withColumn("asked", F.explode(F.array(*fields))).select("failed", "n", "asked.*")
    hit = F.col("failed").bitwiseAND(F.col("mask"))
    count = lambda when: F.sum(F.when(when, F.col("n")).otherwise(0)).cast("long")
    return met.groupBy("policy", "rule").agg(
        count(F.col("failed").bitwiseAND(F.col("bit")) != 0).alias("n_failed"),
        count(hit == F.col("bit")).alias("n_only_this"),
        count(hit == 0).alias("n_kept"),
    )


def keep(docs: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The rows of ``docs`` (all their columns) that the policy keeps, by the same rules; no shuffle."""
    mask = POLICIES[policy]

    clash = [c for c in docs.columns if c in MEASURES or c == "failed"]
    held = {c: fresh(f"_held_{k}", docs) for k, c in enumerate(clash)}
    docs_in = docs.withColumnsRenamed(held) if held else docs

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, text in text_slices(batches, "text"):
            m = measure(text)
            yield pa.RecordBatch.from_arrays([*rows.columns, *[pa.array(m[k]) for k in MEASURES]], names=[*rows.schema.names, *MEASURES])

    out_schema = T.StructType([*docs_in.schema.fields, *[T.StructField(m, T.LongType()) for m in MEASURES]])
    measured = docs_in.mapInArrow(task, out_schema).withColumn("failed", failures())
    kept = measured.where(verdict(mask)).drop(*MEASURES, "failed")
    return kept.withColumnsRenamed({v: k for k, v in held.items()}) if held else kept


def op4_rules_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ledger(table(spark, sf_dir, "documents"))
    base = verdict(POLICIES["base"])
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~base).alias("base_failed"), (base & verdict(POLICIES[CURRENT])).alias("kept"), "failed",
    )


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep(docs)


_WORD = r"'[^\x20\x09-\x0D]+'"
LEDGER_SQL = rf"""
with d as (
  select row_number() over () as r, doc_id, coalesce(text, '') as text from documents
), w as (
  select r, doc_id, text, regexp_extract_all(text, {_WORD}) as ws,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, {_WORD})) as ls from d
), g as (
  select r, len(ws) as n_words, unnest(range(1, len(ws) - 1)) as i, ws from w where len(ws) >= 3
), s as (
  select r, i, count(*) over (partition by r, ws[i], ws[i + 1], ws[i + 2]) as often from g
), m as (
  select r, count(distinct p) as n from (select r, unnest([i, i + 1, i + 2]) as p from s where often >= 2) group by r
), b as (
  select w.doc_id, len(ws)::bigint as n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::bigint as word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::bigint as n_symbols, (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines,
         coalesce(m.n, 0)::bigint as n_repeat_words, len(ls)::bigint as n_lines
  from w left join m using (r)
), f as (
  select *, {" + ".join(f"(case when {rule} then {1 << k} else 0 end)" for k, (_, rule) in enumerate(RULES))} as bits from b
)
"""
ORACLE_SQL = LEDGER_SQL + f"""
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (bits & {POLICIES["base"]}) <> 0 as base_failed,
       (bits & {POLICIES[CURRENT] | POLICIES["base"]}) = 0 as kept, bits::bigint as failed from f
"""
ABLATION_SQL = LEDGER_SQL + "select policy, rule, " + """
  coalesce(sum((bits & bit <> 0)::int), 0)::bigint as n_failed, coalesce(sum(((bits & mask) = bit)::int), 0)::bigint as n_only_this,
  coalesce(sum(((bits & mask) = 0)::int), 0)::bigint as n_kept
from f, (values """ + ", ".join(f"('{p}', {m}, '{n}', {BIT[n]})" for p, m in POLICIES.items() for n, _ in RULES if m & BIT[n]) + """) t(policy, mask, rule, bit) group by policy, rule
"""
