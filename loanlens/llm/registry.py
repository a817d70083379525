"""The queries of this subpackage and their SQL."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

#: Query names and the modules that hold them as ``query``, with ``SQL`` where SQL can speak.
MODULES = {
    "op1_subwords": "subwords",
    "op2_quality_rules": "quality_rules",
    "op3_ngram_model": "ngram_model",
    "op4_toxicity": "toxicity",
    "op5_language_id": "language",
    "op6_suffix_dedup": "suffix_dedup",
    "op7_personal_data": "personal_data",
    "op8_jaccard_join": "jaccard_join",
    "op9_packing": "packing",
    "op10_imatch": "imatch",
    "op11_line_blocks": "line_blocks",
    "op12_conversation_repair": "conversation_repair",
    "op13_token_alignment": "token_alignment",
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
for _name, _module in MODULES.items():
    _found = importlib.import_module(f"loanlens.llm.{_module}")
    QUERIES[_name] = _found.query
    if getattr(_found, "SQL", None):
        ORACLES[_name] = _found.SQL
