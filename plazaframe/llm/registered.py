"""All queries of this package; importing it fills the register."""

from plazaframe.llm import queries_native, queries_quality, queries_search, queries_text, queries_tokens
from plazaframe.llm.queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "queries_native", "queries_quality", "queries_search", "queries_text", "queries_tokens"]
