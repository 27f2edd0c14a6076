"""Registered queries, each beside its equivalent SQL."""

from clientele.plans import aggregates, changes, churn, customer, files, quality, tables  # noqa: F401
from clientele.plans.catalog import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
