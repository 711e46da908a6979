"""All queries of this subpackage; importing the modules fills the registry."""

from __future__ import annotations

from stratalake.llm import decontamination, jaccard, language, licenses, merkle, mixing, neighbours, ranking, sharding, suffix_dedup, toxicity, trie, warc  # noqa: F401
from stratalake.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
