"""Registry of the training-data queries and of their DuckDB statements."""

from __future__ import annotations

from lotguard.llm import (
    chat_format,
    filter_audit,
    ngram_join,
    prefix_trie,
    quality_forest,
    sentence_spans,
    sentencepiece_lattice,
    shard_differencing,
    skip_chain_pii,
    string_tiling,
    suffix_dedup,
    toxicity_kn,
    warc_zstd,
)

_MODULES = [
    suffix_dedup, ngram_join, quality_forest, string_tiling, sentencepiece_lattice, warc_zstd, shard_differencing, chat_format, sentence_spans, toxicity_kn,
    skip_chain_pii, filter_audit, prefix_trie,
]
QUERIES = {k: v for m in _MODULES for k, v in m.QUERIES.items()}
SQL = {k: v for m in _MODULES for k, v in getattr(m, "SQL", {}).items()}
