"""From raw documents to packed training sequences, one written table after another.

Language ID drops documents without a language, the n-gram Jaccard join keeps one document of every
component, suffix-array deduplication cuts passages that occur elsewhere, personal data gives way
to its kind, and packing returns the pieces of all that is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loanlens.llm.frames import table
from loanlens.llm.jaccard_join import near_duplicate_stage
from loanlens.llm.language import language_stage
from loanlens.llm.packing import packing_stage
from loanlens.llm.personal_data import personal_data_stage
from loanlens.llm.suffix_dedup import suffix_stage
from loanlens.session import materialise

STAGES = [
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("repeated_passages", suffix_stage),
    ("personal_data", personal_data_stage),
    ("packing", packing_stage),
]

#: No stage but the joins on sets and bytes has an SQL form, so the rows have none.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
