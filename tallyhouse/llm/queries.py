"""Registered queries of the training-data operators, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.llm.conversation_trie import op13_conversation_trie
from tallyhouse.llm.cross_tokenizers import op12_cross_tokenizers
from tallyhouse.llm.histogram_shards import op1_histogram_shards
from tallyhouse.llm.huffman_tokens import op6_huffman_tokens
from tallyhouse.llm.language_families import op11_language_families
from tallyhouse.llm.ordinal_quality import op4_ordinal_quality
from tallyhouse.llm.qgram_leaks import op3_qgram_leaks
from tallyhouse.llm.quality_rules import op2_quality_rules
from tallyhouse.llm.quality_sql import quality_sql
from tallyhouse.llm.repeated_windows import op5_repeated_windows
from tallyhouse.llm.repeats_sql import repeats_sql
from tallyhouse.llm.sentencepiece_prefix import op10_sentencepiece
from tallyhouse.llm.simhash_blocks import op8_simhash_blocks
from tallyhouse.llm.token_counts import op7_token_counts
from tallyhouse.llm.toxicity_trees import op9_toxicity_trees

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_histogram_shards": op1_histogram_shards,
    "op2_quality_rules": op2_quality_rules,
    "op3_qgram_leaks": op3_qgram_leaks,
    "op4_ordinal_quality": op4_ordinal_quality,
    "op5_repeated_windows": op5_repeated_windows,
    "op6_huffman_tokens": op6_huffman_tokens,
    "op7_token_counts": op7_token_counts,
    "op8_simhash_blocks": op8_simhash_blocks,
    "op9_toxicity_trees": op9_toxicity_trees,
    "op10_sentencepiece": op10_sentencepiece,
    "op11_language_families": op11_language_families,
    "op12_cross_tokenizers": op12_cross_tokenizers,
    "op13_conversation_trie": op13_conversation_trie,
}

ORACLE_SQL: dict[str, str] = {
    "op2_quality_rules": quality_sql(),
    "op5_repeated_windows": repeats_sql(),
}
