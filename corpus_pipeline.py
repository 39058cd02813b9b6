"""The corpus pipeline: quality classifier, quality rules, SimHash near-dedup, packing.

Every stage gets what the one before kept, written as Parquet in the shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from meteocube.llm import pack_pow2, quality_rff, rules_ledger, simhash_bytes
from meteocube.llm.common import materialize, table

STAGES = [
    ("quality_classifier", quality_rff.stage),
    ("quality_rules", rules_ledger.stage),
    ("simhash_near_dedup", simhash_bytes.stage),
    ("packing", pack_pow2.stage),
]

#: Model scores and tokenizer ids are beyond SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
