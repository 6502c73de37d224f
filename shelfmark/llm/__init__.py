"""Operators for preparing training data at scale, each with a registered query."""

from shelfmark.llm import (  # noqa: F401  (importing registers the queries)
    edit_counts,
    embedding_dedup,
    language_id,
    lexical_search,
    line_dedup,
    merkle,
    minhash_dedup,
    mixing,
    packing,
    personal_data,
    quality,
    url_filter,
    warc,
)
from shelfmark.llm.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
