"""Operators for training-data corpora. Nothing outside this subpackage imports it."""

from clientele.llm import queries  # noqa: F401
from clientele.llm.common import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
