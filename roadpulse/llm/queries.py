"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from roadpulse.llm import collocations, exact_dedup, html, language_model, mixing, packing, quality, simhash, token_counts, token_files, topk, tree_bpe, variants

_PARTS = [exact_dedup, mixing, simhash, token_files, quality, packing, html, topk, token_counts, language_model, variants, tree_bpe, collocations]

QUERIES = {key: query for part in _PARTS for key, query in part.QUERIES.items()}
ORACLES = {key: text for part in _PARTS for key, text in part.ORACLES.items()}
