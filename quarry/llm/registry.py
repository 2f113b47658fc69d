"""The queries of this subpackage and, where SQL can express one, the SQL for the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import linededup, sortmeans, trie
from quarry.llm.decontam import op4_decontamination
from quarry.llm.embeddings import op3_embedding_near_dedup
from quarry.llm.jaccard import op5_ngram_jaccard_join
from quarry.llm.langid import op7_language_id
from quarry.llm.langmodel import op8_language_model
from quarry.llm.linededup import op9_line_dedup
from quarry.llm.packing import op6_best_fit_packing
from quarry.llm.pii import op10_pii
from quarry.llm.quality import op2_quality
from quarry.llm.sortmeans import op13_sort_means
from quarry.llm.tokenfile import op12_token_files
from quarry.llm.toxicity import op1_toxicity
from quarry.llm.trie import op11_prefix_trie

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_quality": op2_quality,
    "op3_embedding_near_dedup": op3_embedding_near_dedup,
    "op4_decontamination": op4_decontamination,
    "op5_ngram_jaccard_join": op5_ngram_jaccard_join,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_language_id": op7_language_id,
    "op8_language_model": op8_language_model,
    "op9_line_dedup": op9_line_dedup,
    "op10_pii": op10_pii,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_token_files": op12_token_files,
    "op13_sort_means": op13_sort_means,
}

ORACLE_SQL: dict[str, str] = {
    "op9_line_dedup": linededup.sql_pages(),
    "op11_prefix_trie": trie.sql(),
    "op13_sort_means": sortmeans.sql(),
}
