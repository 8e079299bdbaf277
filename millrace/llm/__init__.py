"""Operators of a training-data pipeline; nothing else in the library imports them."""

from millrace.llm import (  # noqa: F401
    conversation_trie, decontamination, fill_middle, jaccard_join, license_scan, line_dedup, packing, pii, quality, substring_dedup, token_store, toxicity, url_filter,
)
from millrace.llm.common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
