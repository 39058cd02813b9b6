"""Registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from meteocube.llm import chat_format, phrase_mining, rules_ledger
from meteocube.llm.best_two_fit import op12_best_two_fit
from meteocube.llm.bpe_tree import op9_bpe_tree
from meteocube.llm.chat_format import op10_chat_format
from meteocube.llm.embed_pivots import op2_embed_pivots
from meteocube.llm.html_tree import op7_html_tree
from meteocube.llm.huffman_ids import op5_huffman_ids
from meteocube.llm.pack_pow2 import op6_pack_pow2
from meteocube.llm.phrase_mining import op11_phrase_mining
from meteocube.llm.quality_rff import op1_quality_rff
from meteocube.llm.rules_ledger import op4_rules_ledger
from meteocube.llm.simhash_bytes import op8_simhash_bytes
from meteocube.llm.token_alignment import op13_token_alignment
from meteocube.llm.toxicity_fm import op3_toxicity_fm


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_quality_rff, op2_embed_pivots, op3_toxicity_fm, op4_rules_ledger, op5_huffman_ids,
        op6_pack_pow2, op7_html_tree, op8_simhash_bytes, op9_bpe_tree, op10_chat_format,
        op11_phrase_mining, op12_best_two_fit, op13_token_alignment,
    )
    return {f.__name__: f for f in found}


def oracle_queries() -> dict[str, str]:
    return {"op4_rules_ledger": rules_ledger.ORACLE_SQL, "op10_chat_format": chat_format.ORACLE_SQL, "op11_phrase_mining": phrase_mining.ORACLE_SQL}
