"""From raw documents to packed training sequences: five stages, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import common
from quarry.llm.decontam import stage_decontamination
from quarry.llm.jaccard import stage_jaccard_join
from quarry.llm.langid import stage_language_id
from quarry.llm.linededup import stage_line_dedup
from quarry.llm.packing import stage_best_fit_packing

STAGES = [
    ("language_id", stage_language_id),
    ("line_dedup", stage_line_dedup),
    ("ngram_jaccard_join", stage_jaccard_join),
    ("decontamination", stage_decontamination),
    ("best_fit_packing", stage_best_fit_packing),
]

#: Language scores, tokenizing and packing are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each stage reads what the one before it wrote."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
