"""All queries of this folder; importing it registers them with their SQL."""

from chunkspark.llm import (  # noqa: F401
    bpe,
    chat_format,
    conversation_repair,
    exact_dedup,
    jaccard_join,
    language_id,
    lattice_dedup,
    packing,
    quality_rules,
    spelling_variants,
    substring_dedup,
    suffix_dedup,
    url_filter,
)
